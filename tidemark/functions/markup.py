"""Where elements start and end in an HTML page: the per-row helper of the extraction jobs.

Only tags are visited; the text between them is skipped by the regular expression
engine. Positions refer to the source text, so that a kept element can be cut out
verbatim.
"""

from __future__ import annotations

import re
from functools import lru_cache
from html import unescape

_ATTRIBUTES = r"""(?:[^<>=]++|=\s*(?:"[^"]*"|'[^']*'|[^\s>]*))*+"""
_ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]*)))?""")
_RAW_END = {
    name: re.compile(rf"</{name}[^>]*>", re.IGNORECASE) for name in ("script", "style")
}
_SCRIPTS = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(script|style)(?=[\s/>]){_ATTRIBUTES}>.*?(?:</\1[^>]*>|\Z)",
    re.DOTALL | re.IGNORECASE,
)
_MARKUP = re.compile(
    rf"<!--.*?(?:-->|\Z)|<[!?][^>]*>|</?[a-z]{_ATTRIBUTES}>", re.DOTALL | re.IGNORECASE
)
_PARTING = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>", re.DOTALL)
_STRAY_END = re.compile(r"</[a-z][^>]*>", re.IGNORECASE)
_UNSEEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(script|style|template)(?=[\s/>]){_ATTRIBUTES}>.*?(?:</\1[^>]*>|\Z)"
    rf"|</?[a-z]{_ATTRIBUTES}>",
    re.DOTALL | re.IGNORECASE,
)
# What may stand before the body when its start tag is left out.
_PROLOGUE = re.compile(
    rf"(?:\s+|<!--.*?-->|<!doctype[^>]*>|</?(?:html|head|meta|link|base)(?=[\s/>]){_ATTRIBUTES}>"
    rf"|<(title|script|style)(?=[\s/>]){_ATTRIBUTES}>.*?</\1[^>]*>)*",
    re.DOTALL | re.IGNORECASE,
)
_BODY_END = re.compile(r"</(?:body|html)\s*>", re.IGNORECASE)
_SELF_CLOSED = re.compile(r"""(?:^|[\s"'])/\s*$""")

# Elements that never have content.
_VOID = frozenset(
    "area base br col embed frame hr img input link meta param source track wbr".split()
)
# How strongly an open element resists the end tag of an outer one; others count 100.
_STRENGTH = {
    "div": 150, "td": 160, "th": 160, "tr": 170, "thead": 180, "tbody": 180,
    "tfoot": 180, "table": 190, "head": 200, "body": 200, "html": 220,
}
_HEADINGS = "h1 h2 h3 h4 h5 h6"
# Open element -> start tags that end it.
_ENDED_BY = {
    "p": frozenset(f"address blockquote center dd div dl dt {_HEADINGS} hr li ol p pre table td th tr ul".split()),
    "li": frozenset({"li"}),
    "a": frozenset({"a", "table", "td", "th"}),
    "dd": frozenset({"dd", "dt"}),
    "dt": frozenset({"dd", "dt"}),
    "td": frozenset({"td", "th", "tr", "tbody", "tfoot"}),
    "th": frozenset({"td", "th", "tr", "tbody", "tfoot"}),
    "tr": frozenset({"tr", "tbody", "tfoot"}),
    "thead": frozenset({"tbody", "tfoot"}),
    "tbody": frozenset({"tbody", "tfoot"}),
}

STRUCTURE = frozenset("div table thead tbody tfoot tr td th body".split())


class Element:
    """One element; `inner`..`inner_end` is its content within `start`..`end`."""

    __slots__ = ("name", "attributes", "start", "inner", "inner_end", "end", "parent", "_classes")

    def __init__(self, name, attributes, start, inner, parent):
        self.name, self.attributes, self.parent = name, attributes, parent
        self.start, self._classes = start, None
        self.inner = self.inner_end = self.end = inner

    def attribute(self, name):
        for found in _ATTRIBUTE.finditer(self.attributes):
            if found[1].lower() == name:
                return unescape(found[2] or found[3] or found[4] or "")
        return None

    def is_a(self, name, css_class):
        if name is not None and self.name != name:
            return False
        if self._classes is None:
            self._classes = (self.attribute("class") or "").split()
        return css_class in self._classes

    def inside(self, name, css_class):
        outer = self.parent
        while outer is not None and not outer.is_a(name, css_class):
            outer = outer.parent
        return outer is not None


@lru_cache(maxsize=32)
def _scanner(names):
    wanted = "|".join(sorted(names | _RAW_END.keys())) if names else r"[a-z][^\s/>]*"
    return re.compile(
        rf"<!--.*?(?:-->|\Z)|<(/?)({wanted})(?=[\s/>])({_ATTRIBUTES})>", re.DOTALL | re.IGNORECASE
    )


def elements(html, names=None):
    """Elements in document order: all, or those whose tag is in `names`."""
    scan = _scanner(names).search
    found, open_elements, position = [], [], 0
    while (tag := scan(html, position)) is not None:
        position = tag.end()
        if tag[2] is None:
            continue
        name = tag[2].lower()
        if tag[1]:
            _end(open_elements, name, tag.start(), tag.end())
            continue
        while open_elements and name in _ENDED_BY.get(open_elements[-1].name, ()):
            _close(open_elements.pop(), tag.start(), tag.start())
        element = Element(
            name, tag[3], tag.start(), tag.end(), open_elements[-1] if open_elements else None
        )
        if name in _RAW_END:
            close = _RAW_END[name].search(html, position)
            position = close.end() if close else len(html)
            _close(element, close.start() if close else position, position)
            if names is None:
                found.append(element)
            continue
        if name == "body" and any(outer.name == "body" for outer in open_elements):
            continue
        found.append(element)
        if name not in _VOID and not _SELF_CLOSED.search(tag[3]):
            open_elements.append(element)
    for element in open_elements:
        _close(element, len(html), len(html))
    return found


def _close(element, inner_end, end):
    element.inner_end, element.end = inner_end, end


def _end(open_elements, name, start, end):
    strength = _STRENGTH.get(name, 100)
    for depth in range(len(open_elements) - 1, -1, -1):
        if open_elements[depth].name == name:
            for inner in open_elements[depth + 1 :]:
                _close(inner, start, start)
            _close(open_elements[depth], start, end)
            del open_elements[depth:]
            return
        if _STRENGTH.get(open_elements[depth].name, 100) > strength:
            return


def has_text(html, scripts_count=False):
    """Whether any non-white text remains outside tags and comments."""
    markup, position = (_MARKUP if scripts_count else _UNSEEN), 0
    for tag in markup.finditer(html):
        if unescape(html[position : tag.start()]).strip():
            return True
        position = tag.end()
    return bool(unescape(html[position:]).strip())


def without_scripts(html):
    return _SCRIPTS.sub(lambda match: "" if match[1] else match[0], html)


def body_span(html, found):
    """The body element, or what an omitted body start tag would enclose."""
    for element in found:
        if element.name == "body":
            return element.start, element.end
    start = _PROLOGUE.match(html).end()
    close = _BODY_END.search(html, start)
    return start, close.start() if close else len(html)


def direct_texts(html, element, found):
    """Text nodes that are immediate children of `element`, in order, decoded."""
    position = element.inner
    for child in [*(e for e in found if e.parent is element), None]:
        stop = element.inner_end if child is None else child.start
        # Between children stand comments, which part text nodes, and stray end tags, which do not.
        for piece in _PARTING.split(html[position:stop]):
            if text := _STRAY_END.sub("", piece):
                yield unescape(text)
        position = stop if child is None else child.end


_DECLARED = re.compile(rb"""<meta[^>]+charset\s*=\s*["']?\s*([a-z0-9_.:-]+)""", re.IGNORECASE)
_MARKS = ((b"\xef\xbb\xbf", "utf-8"), (b"\xff\xfe", "utf-16-le"), (b"\xfe\xff", "utf-16-be"))
_HEAD_ENDS = re.compile(rb"</head[\s/>]|<body[\s/>]", re.IGNORECASE)


def decode(raw):
    """Text of a page: byte order mark, charset declared in the head, UTF-8, then Windows-1252."""
    for mark, encoding in _MARKS:
        if raw.startswith(mark):
            return raw[len(mark) :].decode(encoding, "replace")
    head = _HEAD_ENDS.search(raw)
    declared = _DECLARED.search(raw, 0, head.start() if head else len(raw))
    for encoding in ([declared[1].decode("ascii")] if declared else []) + ["utf-8"]:
        try:
            return raw.decode(encoding)
        except (LookupError, UnicodeDecodeError):
            pass
    return raw.decode("windows-1252", "replace")


#: First bytes of the file kinds that are served where a page was expected (fixed values).
_SIGNATURES = (b"%PDF", b"PK\x03\x04", b"\xd0\xcf\x11\xe0\xa1\xb1\x1a\xe1")


def is_binary(raw):
    """Whether a response is a file of a known binary kind; stray control bytes do not make a page one."""
    return raw.startswith(_SIGNATURES)
