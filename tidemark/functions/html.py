"""The three HTML extraction jobs as Arrow UDFs.

A page that cannot be handled yields an `error` in its own row and nothing else, so
one bad page never fails the task.
"""

from __future__ import annotations

from urllib.parse import urljoin, urlparse

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tidemark.functions import markup
from tidemark.functions.shipping import ship_package

# Pages that are handled at once, so that a batch of ten thousand is not in memory several times over.
PIECE_BYTES, PIECE_ROWS = 1 << 20, 500

CARD = T.StructType(
    [
        T.StructField("position", T.IntegerType()),
        T.StructField("identifier", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("published_date", T.StringType()),
        T.StructField("doc_url", T.StringType()),
    ]
)


def _outcome(value: T.DataType) -> T.StructType:
    """What a row yields: a value, or the error that took its place."""
    return T.StructType([T.StructField("value", value), T.StructField("error", T.StringType())])


def _base_url(url, page, found):
    for element in found:
        if element.name == "base" and (href := element.attribute("href")) is not None:
            return urljoin(url, href)
    return url


def clean_page(raw, tag="div", css_class="content"):
    """Bytes of the kept element: the first container with text, else the body."""
    page = markup.decode(raw)
    found = markup.elements(page, markup.STRUCTURE | {tag})
    kept = next((e for e in found if e.is_a(tag, css_class)), None)
    if kept is not None and markup.has_text(page[kept.inner : kept.inner_end]):
        start, end = kept.start, kept.end
    else:
        start, end = markup.body_span(page, found)
    return markup.without_scripts(page[start:end]).encode("utf-8", "replace")


def attachment_url(raw, url):
    """Absolute pdf/doc link of a page whose content container is empty, else None."""
    if markup.is_binary(raw):
        raise ValueError("binary response where a page was expected")
    page = markup.decode(raw)
    found = markup.elements(page, markup.STRUCTURE | {"a", "base"})
    content = next((e for e in found if e.is_a("div", "content")), None)
    if content is not None and markup.has_text(page[content.inner : content.inner_end], scripts_count=True):
        return None
    for element in found:
        if element.is_a("a", "download") and element.inside("div", "related-file"):
            if (href := element.attribute("href")) is not None:
                is_file = urlparse(href).path.lower().endswith((".pdf", ".doc", ".docx"))
                return urljoin(_base_url(url, page, found), href) if is_file else None
    return None


def listing_cards(raw, url):
    """One dict per result card of a listing page, in page order."""
    page = markup.decode(raw)
    found = markup.elements(page)
    base = _base_url(url, page, found)
    cards = []
    for index, card in enumerate(found):
        if card.is_a("li", "each-item"):
            within = [card]
            for element in found[index + 1 :]:
                if element.start >= card.end:
                    break
                within.append(element)
            cards.append(_card(page, within, base, len(cards)))
    return cards


def _card(page, within, base, position):
    def first_text(chosen):
        return next((t for e in chosen for t in markup.direct_texts(page, e, within)), None)

    links = [e for e in within if e.name == "a" and e.inside("h2", "title")]
    href = next((h for e in links if (h := e.attribute("href")) is not None), None)
    identifier = first_text(links) or first_text(e for e in within if e.is_a(None, "refNO"))
    return {
        "position": position,
        "identifier": identifier.strip() if identifier else None,
        "description": (first_text(e for e in within if e.is_a("p", "description")) or "").strip(),
        "published_date": (first_text(e for e in within if e.is_a("span", "date")) or "").strip(),
        "doc_url": _joined(base, href) if href else None,
    }


def _joined(base, href):
    try:
        return urljoin(base, href)
    except ValueError:
        return href  # no URL at all: the record fails by itself, its page's others do not


def _by_row(function, value_type, *columns):
    """The outcome of each row; pages are Python objects, and results lists, for a piece of the batch at a time."""
    outcome = to_arrow_type(_outcome(value_type))
    pieces = (_outcomes(function, outcome, [c.slice(at, n) for c in columns]) for at, n in _pieces(columns[0]))
    return pa.concat_arrays([pa.array([], outcome), *pieces])


def _pieces(pages):
    """(start, rows) of runs of about PIECE_BYTES; a longer page is alone."""
    ends = pc.cumulative_sum(pc.fill_null(pc.binary_length(pages), 0).cast(pa.int64())).to_numpy()
    at = 0
    while at < len(ends):
        before = ends[at - 1] if at else 0
        stop = max(int(ends.searchsorted(before + PIECE_BYTES, side="right")), at + 1)
        stop = min(stop, at + PIECE_ROWS)
        yield at, stop - at
        at = stop


def _outcomes(function, outcome, columns):
    results, errors = [], []
    for row in zip(*(column.to_pylist() for column in columns)):
        result = error = None
        if row[0] is not None:
            try:
                result = function(*row)
            except Exception as failure:  # noqa: BLE001 - isolated in the row's error column
                error = f"{type(failure).__name__}: {failure}"
        results.append(result)
        errors.append(error)
    return pa.StructArray.from_arrays([pa.array(results, outcome[0].type), pa.array(errors, outcome[1].type)], fields=list(outcome))


def clean_html(content: Column, tag: str = "div", css_class: str = "content") -> Column:
    """struct<value:binary, error:string>; NULL content gives NULL, nothing parsed."""

    @F.arrow_udf(returnType=_outcome(T.BinaryType()))
    def clean(pages: pa.Array) -> pa.Array:
        return _by_row(lambda raw: clean_page(raw, tag, css_class), T.BinaryType(), pages)

    ship_package()
    # Declared non-deterministic: a filter on the outcome must not have each page parsed again.
    return clean.asNondeterministic()(content.cast("binary"))


@F.arrow_udf(returnType=_outcome(T.StringType()))
def _attachments(pages: pa.Array, urls: pa.Array) -> pa.Array:
    return _by_row(attachment_url, T.StringType(), pages, urls)


def shell_attachment(content: Column, url: Column) -> Column:
    """struct<value:string, error:string>: attachment of a shell page, else NULL."""
    ship_package()
    return _attachments.asNondeterministic()(content.cast("binary"), url)


@F.arrow_udf(returnType=_outcome(T.ArrayType(CARD)))
def _cards(pages: pa.Array, urls: pa.Array) -> pa.Array:
    return _by_row(listing_cards, T.ArrayType(CARD), pages, urls)


def cards(content: Column, url: Column) -> Column:
    """struct<value:array<card>, error:string> of a listing page."""
    ship_package()
    return _cards.asNondeterministic()(content.cast("binary"), url)
