"""URL classification and search URLs as Spark expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Scheme, authority, then the path up to a query or fragment.
_PATH = r"\A(?:[a-z][a-z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)"


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def url_path(url: Column | str) -> Column:
    """Lower-cased path of a URL.

    A regular expression rather than parse_url, which raises on a space in the URL.
    """
    cleaned = F.regexp_replace(F.translate(_column(url), "\t\r\n", ""), r"\A[\x00-\x20]+", "")
    path = F.regexp_extract(F.lower(cleaned), _PATH, 1)
    return F.regexp_replace(path, r";[^/]*\z", "")


def doc_type(url: Column | str) -> Column:
    """'pdf', 'doc' or 'html' from the path's extension; NULL without a URL."""
    path = url_path(url)
    return (
        F.when(_column(url).isNull() | (_column(url) == ""), F.lit(None).cast("string"))
        .when(path.endswith(".pdf"), "pdf")
        .when(path.endswith(".doc") | path.endswith(".docx"), "doc")
        .otherwise("html")
    )


def form_encode(value: Column | str) -> Column:
    """Form encoding with '/' kept literal; '~' is safe and '*' is not."""
    encoded = F.url_encode(_column(value).cast("string"))
    for found, wanted in (("%2F", "/"), ("%7E", "~"), ("*", "%2A")):
        encoded = F.replace(encoded, F.lit(found), F.lit(wanted))
    return encoded


def search_url(
    base_url: str,
    from_param: Column | str,
    to_param: Column | str,
    body_id: Column | str,
    page: Column | str,
) -> Column:
    """Search URL of one (body, window, page); the parameter order is fixed."""
    return F.concat(
        F.lit(base_url + "?decisions=1&from="),
        form_encode(from_param),
        F.lit("&to="),
        form_encode(to_param),
        F.lit("&body="),
        form_encode(body_id),
        F.lit("&pageNumber="),
        form_encode(page),
    )


def result_total(text: Column | str) -> Column:
    """Total announced by a listing page, from its first 'of N results'; else NULL.

    The white-space class is spelt out because Python's includes U+00A0 and
    U+001C..U+001F, which Java's does not.
    """
    gap = r"[\s\x1c-\x1f]+"
    digits = F.regexp_extract(_column(text), rf"(?iU)of{gap}(\d+){gap}results", 1)
    return F.nullif(digits, F.lit("")).try_cast("bigint")


def fetched(status: Column | str) -> Column:
    """True for a response that reaches the parser (2xx)."""
    return F.coalesce(_column(status).between(200, 299), F.lit(False))
