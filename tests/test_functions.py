import hashlib
import re
from urllib.parse import urlencode, urlparse

import pytest
from pyspark.sql import functions as F

from tidemark.functions import keys, urls
from tidemark.functions.text import strip


def column(spark, values, expression):
    rows = spark.createDataFrame(list(enumerate(values)), "i int, v string")
    return [r["r"] for r in rows.select("i", expression.alias("r")).orderBy("i").collect()]


def test_doc_type(spark):
    expected = {
        "/rel/x.PDF": "pdf",
        "notes.doc": "doc",
        "ftp://files.example/q 1/r 2.pdf": "pdf",
        "https://files.example/k.pdf;v=1": "pdf",
        "https://files.example/k;v=1/m.pdf": "pdf",
        "https://files.example/k.html;m.pdf": "html",
        "https://files.example?f=k.pdf": "html",
        "https://files.example#k.pdf": "html",
        "https://files.pdf": "html",
        "//files.doc/k.docx#z": "doc",
        "  https://files.example/m.pdf": "pdf",
        "https://files.example/m.p\ndf": "pdf",
        "https://files.example/m.pdf ": "html",
        "https://files.example/k.pdf/": "html",
        "mailto:k.pdf": "pdf",
        "file:///tmp/k.doc": "doc",
        "HTTPS://FILES.EXAMPLE/Q.DocX": "doc",
        "https://files.example/ö.pdf": "pdf",
        "1x:k.pdf": "pdf",
        "https://files.example/.pdf": "pdf",
        "https://files.example/k.pdf?x#y?z.html": "pdf",
        "?k.pdf": "html",
        "#k.pdf": "html",
        "k;m;n.pdf": "html",
        "https://files.example/2019/ruling-7": "html",
        "https://files.example/RULING.Pdf?download=1": "pdf",
        "": None,
        None: None,
    }
    assert column(spark, [*expected], urls.doc_type("v")) == [*expected.values()]


def test_result_total(spark):
    expected = {
        "page 2 of 41 Results": 41, "nothing found": None, "of 5,120 results": None, "OF\xa07\x1cRESULTS": 7,
        "of\n12\tResults of 13 results": 12, "of results": None, "off 6 results": None, "roof 6 results": 6, "of 6 result": None,
        "of 99999999999999999999 results": None, None: None,
    }
    assert column(spark, [*expected], urls.result_total("v")) == [*expected.values()]


def test_search_url_is_form_encoded(spark):
    bodies = ["15376", "a b/c", "é&=~*-_.", "x+y%"]
    got = column(spark, bodies, urls.search_url("https://s.example/q", F.lit("01/01/2024"), F.lit("31/01/2024"), "v", F.lit(2)))
    want = [
        "https://s.example/q?" + urlencode(
            {"decisions": 1, "from": "01/01/2024", "to": "31/01/2024", "body": b, "pageNumber": 2}, safe="/")
        for b in bodies
    ]
    assert got == want


def test_strip_removes_what_python_removes(spark):
    spaces = "".join(chr(c) for c in range(0x3100) if chr(c).isspace())
    values = [f"{spaces}a b\xa0c{spaces}", spaces, "", "plain", "​kept​", None]
    assert column(spark, values, strip("v")) == [None if v is None else v.strip() for v in values]


def test_keys(spark):
    rows = spark.sql(
        """SELECT * FROM VALUES
        (1, 'Workplace Relations Commission', 'ADJ 1 A', DATE '2024-01-01', 'html'),
        (2, 'Labour Court', NULL, DATE '2024-01-01', 'pdf'),
        (3, 'Labour Court', 'X', DATE '2024-02-01', NULL),
        (4, 'Labour Court', 'X', DATE '2024-02-01', ''),
        (5, NULL, 'X', DATE '2024-02-01', 'doc') AS t(i, body, identifier, partition_date, doc_type)"""
    )
    got = {
        r["i"]: (r["l"], r["c"], r["lt"], r["ct"])
        for r in rows.select(
            "i", keys.landing_key().alias("l"), keys.clean_key().alias("c"),
            keys.content_type(keys.extension("doc_type")).alias("lt"), keys.content_type("doc_type").alias("ct"),
        ).collect()
    }
    other = "application/octet-stream"
    assert got == {
        1: ("workplace-relations-commission/2024-01-01/ADJ 1 A.html",
            "workplace-relations-commission/2024-01-01/ADJ1A.html", "text/html", "text/html"),
        2: ("labour-court/2024-01-01/None.pdf", None, "application/pdf", "application/pdf"),
        3: ("labour-court/2024-02-01/X.html", "labour-court/2024-02-01/X.html", "text/html", other),
        4: ("labour-court/2024-02-01/X.html", "labour-court/2024-02-01/X.html", "text/html", other),
        5: (None, None, "application/msword", "application/msword"),
    }


def test_hash(spark):
    values = ["", "abc", "é ü 漢"]
    assert column(spark, values, keys.file_hash("v")) == [hashlib.sha256(v.encode()).hexdigest() for v in values]
