"""Fill-in-middle against the rule written plainly, over odd, empty, long and repeated texts."""

import collections
import hashlib
import random
import re

import pytest

from tidemark.llm import infill

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plainly(doc_id, text):
    text = text or ""
    units = UNIT.findall(text)
    assert "".join(units) == text
    digits = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digits[i : i + 8], 16) for i in range(0, 32, 8)]
    n = len(units)
    a, b = sorted(x % (n + 1) for x in h[:2])
    prefix, middle, suffix = ("".join(u) for u in (units[:a], units[a:b], units[b:]))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return doc_id, n, "plain", None, None, text
    if h[3] % 100 < 80:
        return doc_id, n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return doc_id, n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


@pytest.fixture(scope="module")
def texts():
    random.seed(3)
    words = ["a", "the", "wörter", "漢字", "<", "<P", ">", "P>", "\U0001f600", "x" * 40, "\xa0", "\x1c"]
    gaps = [" ", "  ", "\n", "\t \r\n", "\x0b", "\x0c"]
    say = lambda n: "".join(random.choice(gaps) + random.choice(words) for _ in range(n))
    odd = [None, "", " ", "\n\n", "one", " one", "one ", "<M>", "a <S> b", "<P", "<<P>", "é" * 20_000, "x" * 9001 + " y", say(30_000)]
    rows = [(i, t) for i in range(0, 400, 20) for t in odd] + [(i, say(random.randint(1, 60))) for i in range(400)]
    return rows + [(None, t) for t in ("one two three", "one two three", None)]


def test_against_the_rule(spark, texts):
    # The other columns have names that the operator uses itself.
    frame = spark.createDataFrame([(i, t, 1, "x") for i, t in texts], "doc_id long, text string, part int, form string").repartition(3)
    got = collections.Counter(tuple(r) for r in infill.transform(frame).collect())
    want = collections.Counter()
    for doc_id, text in texts:
        *told, output = plainly(doc_id, text)
        i, n, form, *chars = told
        want[(i, n, form, *chars, sha(output), sha(text or ""))] += 1
    assert got == want
    assert {k[2] for k in want} == {"plain", "spm", "psm"}


def test_small_pieces_give_the_same(spark, texts):
    frame = spark.createDataFrame([r for r in texts if len(r[1] or "") < 2000], "doc_id long, text string")
    whole, small = (infill.transform(frame, piece=p) for p in (infill.PIECE, 5))
    assert collections.Counter(map(tuple, whole.collect())) == collections.Counter(map(tuple, small.collect()))


def test_outputs_and_restoring(spark, texts):
    frame = spark.createDataFrame(texts, "doc_id long, text string")
    got = collections.Counter(tuple(r) for r in infill.outputs(frame).collect())
    want = collections.Counter()
    for doc_id, text in texts:
        _, _, form, _, _, output = plainly(doc_id, text)
        want[(doc_id, form, output)] += 1
        assert infill.restore(output, form) == (text or "")
    assert got == want


def test_empty_table_and_plan(spark, texts):
    frame = spark.createDataFrame([], "doc_id string, text string")
    assert infill.transform(frame).collect() == []
    rows = spark.createDataFrame(texts, "doc_id long, text string")
    plan = infill.transform(rows)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1, "restoring sorts within the task"
