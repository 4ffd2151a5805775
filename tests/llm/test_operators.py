"""Every operator against a plain version, over small tables with nulls, repeats, empty texts and odd columns."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import automata, bpe, chat, descent, maxent, minhash, packing, quality_rules, suffixes, voting

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(scope="module")
def texts():
    random.seed(5)
    words = ["the", "Of", "é", "wörter", "a.b", "x,", "漢字", "and", "in", "re"] + [f"w{i}" for i in range(300)]
    say = lambda n: " ".join(random.choice(words) for _ in range(n))
    shared, near = say(60), say(120)
    out = [None, "", " \n\t", "one two", "one two", "A b C d e", "a B c D E"]
    out += [say(random.randint(5, 80)) for _ in range(20)]
    out += [f"{say(9)} {shared}\n{say(12)}", f"{shared} {say(4)}", say(20) + "  " + shared, near, near, near + " tail", "lead " + near]
    out += ["loop line here now " * 60, "x" * 3000 + " y", f"{shared} {shared}", "re\nre\nthe of\nthe of\n\n", "GO!! " * 30]
    return list(enumerate(out)) + [(3, "one two"), (None, "no id"), (None, "no id"), (None, None)]


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, "x", 1, i) for i, t in texts]
    schema = "doc_id long, text string, h1 string, n_words int, score long"  # names that operators use themselves
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture(scope="module")
def labels(spark, texts):
    rows = [(i, int(i % 4 != 0), 0) for i, _ in texts if i is not None]
    return spark.createDataFrame([*rows, (None, 1, 0), (5, None, None)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def none(docs):
    return docs.limit(0)


def ordered(rows):
    return sorted(rows, key=repr)


def test_quality_rules(docs, labels, texts, none):
    buckets = quality_rules.BUCKETS
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    chain = lambda xs: __import__("functools").reduce(lambda s, x: xxhash.xxh64(x, seed=s).intdigest(), xs, 42)
    raw = lambda x: x.to_bytes(8, "little")

    def features(text):
        h = [xxhash.xxh64(w.encode(), seed=42).intdigest() for w in WORD.findall(text or "")]
        return [signed(x) % buckets for x in h + [chain([raw(a), raw(b)]) for a, b in zip(h, h[1:], strict=False)]]

    trusted = {r[0] for r in quality_rules.trusted_ids(labels).collect()}
    target, corpus = collections.Counter(), collections.Counter()
    for i, t in texts:
        corpus.update(features(t))
        target.update(features(t) if i in trusted else [])
    nt, nc = sum(target.values()), sum(corpus.values())
    ratio = lambda b: np.log((target[b] + 1) / (nt + buckets)) - np.log((corpus[b] + 1) / (nc + buckets))
    want = []
    for i, t in texts:
        t = t or ""
        w, f = WORD.findall(t), features(t)
        windows = [tuple(w[k : k + 5]) for k in range(len(w) - 4)]
        often = collections.Counter(windows)
        covered = {k + j for k, x in enumerate(windows) if often[x] > 1 for j in range(5)}
        lines = [x for x in t.split("\n") if WORD.search(x)]
        failed = len(w) < 10 or 100 * len(covered) > 20 * len(w)
        score = sum(map(ratio, f)) / len(f) if f else 0.0
        want.append((i, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered), failed, round(score, 9), not failed and score >= quality_rules.THRESHOLD))
    got = [(*r[:7], round(r[7], 9), r[8]) for r in quality_rules.judge(docs, labels).collect()]
    assert ordered(got) == ordered(want)
    kept = quality_rules.accepted(docs, labels)
    assert kept.columns == docs.columns
    assert kept.count() == sum(x[-1] for x in want)
    assert quality_rules.judge(none, labels).count() == 0
    assert quality_rules.judge(docs, labels.limit(0)).count() == len(texts)


def test_language_model(docs, texts, none):
    out = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    tokens = [(i, out(i), WORD.findall((t or "").translate(LOWER)) + [None]) for i, t in texts]
    c = collections.Counter(w for _, held, t in tokens if not held for w in t)
    n, v = sum(c.values()), len(c)
    want = [(i, held, len(t), sum(c[w] > 0 for w in t), n, round(sum(np.log10((c[w] + 1) / (n + v + 1)) for w in t), 6)) for i, held, t in tokens]
    rows = maxent.score(docs).collect()
    assert ordered([(*r[:5], round(r[5], 6)) for r in rows]) == ordered(want)
    assert all(r["score"] < 0 for r in rows)
    train = [r for r in rows if not r["held_out"]]
    assert sum(r["score"] for r in train) > sum(r["base_score"] for r in train)
    assert maxent.score(none).count() == 0


def test_language_model_sums_to_one():
    rng = np.random.default_rng(0)
    keys = np.sort(rng.choice(1 << 40, 5000, False))
    known = maxent.Vocabulary(keys, rng.permutation(5000), rng.integers(1, 50, 5000), 200_000, 9000)
    model = maxent.Model(known)
    hashed = [np.full(5001, 77 << 40, np.uint64)] * 3
    ranks = np.append(np.arange(5000), maxent.HELD)
    # The start is the add-one unigram; moved, it still is a distribution over the held words and the rest of them.
    start = np.exp(model.log_probability(ranks, hashed))
    by_rank = np.empty(5000)
    by_rank[known.ranks] = known.counts
    assert np.allclose(start[:-1], (by_rank + 1) / (200_000 + 9000 + 1)) and np.isclose(start[-1], known.rest / 209_001)
    model.table[:] = rng.normal(size=model.table.shape)
    every = np.append(np.arange(maxent.HELD), maxent.HELD)
    assert np.isclose(np.exp(model.log_probability(every, [np.full(len(every), 5 << 50, np.uint64)] * 3)).sum(), 1)


def test_language_model_beats_the_base_on_held_out_texts(spark, sf_dir):
    rows = maxent.score(spark.read.parquet(f"{sf_dir}/documents.parquet")).where("held_out")
    got = rows.agg(*(F.sum(c).alias(c) for c in ("n_tokens", "base_score", "score"))).first()
    assert got["score"] / got["n_tokens"] > got["base_score"] / got["n_tokens"] + 0.05


def test_language_model_rounds_and_nothing_to_learn_from(spark, docs, texts):
    """A second round is a move along the gradient of what the first one has made: it fits the training rows better."""
    fit = [maxent.score(docs, rounds=r).where("NOT held_out").agg(F.sum("score")).first()[0] for r in (0, 1, 2)]
    assert fit[0] < fit[1] < fit[2]
    base = maxent.score(docs, rounds=0).collect()
    assert all(np.isclose(r["score"], r["base_score"]) for r in base)
    out = [(i, t) for i, t in texts if i is not None and zlib.crc32(str(i).encode()) % 7 == 2]
    rows = maxent.score(spark.createDataFrame(out, "doc_id long, text string")).collect()
    assert len(rows) == len(out) and all(r["train_tokens"] == r["n_known"] == 0 and r["score"] == r["base_score"] == 0 for r in rows)


def test_votes(spark, docs, labels, sf_dir, texts, none):
    rows = voting.classify(docs, labels).collect()
    assert len(rows) == len(texts) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)
    assert voting.accepted(docs, labels).columns == docs.columns
    assert voting.classify(none, labels).count() == 0
    assert {r["score"] for r in voting.classify(docs, labels.limit(0)).collect()} == {0.5}
    given, marks = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")
    held = voting.classify(given, marks).where("held_out").join(marks, "doc_id")
    right = held.agg(F.avg((F.col("predicted") == F.col("quality")).cast("double"))).first()[0]
    assert right > 0.9


def test_votes_exact():
    rng = np.random.default_rng(1)
    x, y = rng.normal(size=(700, 8)), rng.normal(size=(60, 8))
    label = rng.integers(0, 2, 60).astype(float)
    got = voting.vote(x, y, label, 5)
    for row, score in zip(x, got, strict=True):
        near = np.argsort(row @ y.T)[-5:]
        weight = np.maximum(row @ y[near].T, 0) ** 4
        assert np.isclose(score, (weight * label[near]).sum() / weight.sum())


def test_chat(spark):
    said = "\\### Assistant: </turn> ok"
    rows = [(1, 0, "user", said), (1, 1, "assistant", said), (2, 0, None, None), (2, 1, "a: b\\", "x:\n#<"), (None, 0, "assistant", "é 漢"),
            (3, 1, "assistant", "second  "), (3, 0, "assistant", " first\n"), (3, 1, "assistant", "second  "), (4, None, "assistant", "")]
    turns = spark.createDataFrame([(*r, 9) for r in rows], "conv_id long, turn int, role string, text string, ids int")
    for block in (1, chat.BLOCK):
        got = {r["conv_id"]: r for r in chat.digests(chat.format_conversations(turns, block=block)).collect()}
        assert len(got) == 5
        for conv, row in got.items():
            own = sorted([r for r in rows if r[0] == conv], key=lambda r: (-1 if r[1] is None else r[1], r[2] or "", r[3] or ""))
            learned = "".join(r[3] or "" for r in own if r[2] == "assistant")
            text = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in own)
            assert row["n_turns"] == len(own) and row["turns_sha256"] == hashlib.sha256(text.encode()).hexdigest()
            assert row["loss_chars"] == len(learned) and row["loss_sha256"] == hashlib.sha256(learned.encode()).hexdigest()
    assert chat.digests(chat.format_conversations(turns.limit(0))).count() == 0


def test_near_vectors(spark):
    rng = np.random.default_rng(3)
    near = [(c + 0.15 * rng.normal(size=16)).tolist() for c in rng.normal(size=(6, 16)) for _ in range(9)]
    vectors = near + near[:3] + rng.normal(size=(60, 16)).tolist() + [None, [0.0] * 16, [float("nan")] * 16, [None] * 16, []]
    rows = [(i, v, 0) for i, v in enumerate(vectors)] + [(None, near[0], 0), (0, near[0], 0)]
    got = descent.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()
    ids = [r[0] for r in rows]
    good = [i is not None and v is not None and len(v) == 16 and None not in v and np.isfinite(v).all() and any(v) for i, v, _ in rows]
    x = np.array([v if g else [0.0] * 16 for (_, v, _), g in zip(rows, good, strict=True)])
    norm = np.sqrt((x * x).sum(1))
    link = (x @ x.T >= 0.9 * np.outer(norm, norm)) & np.outer(good, good)
    np.fill_diagonal(link, False)
    reach = link | np.eye(len(rows), dtype=bool)
    for _ in range(6):
        reach = (reach.astype(int) @ reach.astype(int)) > 0
    low = [min((ids[j] for j in np.flatnonzero(reach[i]) if ids[j] is not None), default=None) if ids[i] is not None else None for i in range(len(rows))]
    want = [(ids[i], int(link[i].sum()), low[i], ids[i] is None or ids[i] == low[i]) for i in range(len(rows))]
    assert ordered(map(tuple, got)) == ordered(want)


@pytest.mark.parametrize("crowd", [1, suffixes.CROWD])
def test_repeated_bytes(docs, texts, none, crowd, monkeypatch):
    monkeypatch.setattr(suffixes, "CROWD", crowd)
    raw = [(t or "").encode() for _, t in texts]
    count = collections.Counter(t[i : i + 60] for t in raw for i in range(len(t) - 59))
    want = []
    for (i, _), t in zip(texts, raw, strict=True):
        gone = np.zeros(len(t), bool)
        for k in range(len(t) - 59):
            gone[k : k + 60] |= count[t[k : k + 60]] > 1
        runs = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
        kept = np.frombuffer(t, np.uint8)[~gone].tobytes()
        want.append((i, len(t), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    assert ordered(map(tuple, suffixes.remove_repeats(docs, 60, 8).collect())) == ordered(want)
    assert suffixes.remove_repeats(none).count() == 0


@pytest.mark.parametrize("crowd", [1, 200])
def test_repeated_words(docs, texts, none, crowd, monkeypatch):
    monkeypatch.setattr(automata, "repeated_spans", lambda *a: __import__("tidemark.llm.repeats", fromlist=["x"]).repeated_spans(*a, crowd))
    words = [WORD.findall(t or "") for _, t in texts]
    count = collections.Counter(tuple(w[i : i + 12]) for w in words for i in range(len(w) - 11))
    want = []
    for (i, _), w in zip(texts, words, strict=True):
        gone = np.zeros(len(w), bool)
        for k in range(len(w) - 11):
            gone[k : k + 12] |= count[tuple(w[k : k + 12])] > 1
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        want.append((i, len(w), int(gone.sum()), hashlib.sha256(kept.encode()).hexdigest()))
    assert ordered(map(tuple, automata.remove_repeats(docs, 12, 4).collect())) == ordered(want)
    assert automata.remove_repeats(none).count() == 0


def test_near_texts(docs, texts, none):
    def shingles(t):
        w = WORD.findall((t or "").translate(LOWER))
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    sets = [shingles(t) for _, t in texts]
    ids = [i for i, _ in texts]
    n = len(ids)
    link = np.array([[bool(a and b) and i is not None and j is not None and 100 * len(a & b) >= 85 * len(a | b) for j, b in zip(ids, sets, strict=True)] for i, a in zip(ids, sets, strict=True)])
    reach = link | np.eye(n, dtype=bool)
    for _ in range(6):
        reach = (reach.astype(int) @ reach.astype(int)) > 0
    low = [None if ids[i] is None else min(ids[j] for j in np.flatnonzero(reach[i])) for i in range(n)]
    want = [(ids[i], len(sets[i]), low[i], ids[i] is None or low[i] == ids[i]) for i in range(n)]
    assert ordered(map(tuple, minhash.near_duplicates(docs).collect())) == ordered(want)
    assert minhash.near_duplicates(none).count() == 0


def test_packing(docs, texts, none):
    library = Tokenizer.from_file(packing.VOCABULARY)
    want = ordered((i, [*library.encode(t or "", add_special_tokens=False).ids, 0]) for i, t in texts)
    pieces = packing.pack(docs, length=64).collect()
    at = sorted((r["sequence_id"], r["offset"], r["length"]) for r in pieces)
    assert all(s * 64 + o + n == t * 64 + p for (s, o, n), (t, p, _) in zip(at, at[1:], strict=False)) and at[0][:2] == (0, 0)
    assert all(0 < r["length"] <= 64 - r["offset"] and zlib.crc32(bytes(r["ids"])) == r["ids_crc32"] for r in pieces)
    rows, held = [], None
    for r in sorted(pieces, key=lambda r: (r["sequence_id"], r["offset"])):
        ids = np.frombuffer(r["ids"], "<u4").tolist()
        if r["start"] == 0:
            held = (r["doc_id"], [])
            rows.append(held)
        assert len(held[1]) == r["start"]
        held[1].extend(ids)
    assert ordered(rows) == want
    assert packing.pack(none).count() == 0
    # The tokens of the first pass are cut where they lie.
    plan = packing.pack(docs, ids=False)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


def test_byte_bpe(docs, texts, none):
    import public_tokenizers

    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.ranks_of(bpe.VOCABULARY), special_tokens={})
    want = []
    for i, t in texts:
        ids = np.array(library.encode_ordinary(t or ""), "<u4")
        want.append((i, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert ordered(map(tuple, bpe.codec_rows(docs).collect())) == ordered(want)
    assert bpe.codec_rows(none).count() == 0
    codec, rng = bpe.Codec(bpe.VOCABULARY), random.Random(2)
    odd = ["".join(rng.choice(' \n\t\r\x1c　aéß漢😀1.,!\'"sd') for _ in range(rng.randint(0, 50))) for _ in range(3000)]
    flat, bounds = codec.encode(pa.array(odd))
    for text, ids in zip(odd, np.split(flat, bounds[1:-1]), strict=True):
        assert ids.tolist() == library.encode_ordinary(text) and codec.decode(ids) == text
        assert "".join(codec.decoder.stream(ids[k : k + 1] for k in range(len(ids)))) == text


def test_near_texts_of_one_base(spark):
    """Copies with edits of their own, near the threshold: links among them are all found, also those no center shows."""
    rng = np.random.default_rng(5)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(150):
        words = list(base)
        for at in rng.choice(120, int(rng.integers(1, 5)), replace=False):
            words[at] = f"x{rng.integers(0, 40)}"
        rows.append((i, " ".join(words)))
    sets = [{tuple(t.split()[k : k + 5]) for k in range(116)} for _, t in rows]
    low = list(range(len(rows)))
    links = [(i, j) for i in low for j in low if i < j and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j])]
    assert links and len(links) < len(rows) * (len(rows) - 1) / 4
    for _ in rows:
        for i, j in links:
            low[i] = low[j] = min(low[i], low[j])
    found = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.component_id) for r in found) == [(i, low[i]) for i in range(len(rows))]


def test_language_model_learns_from_histories(spark):
    """Words far from the most frequent ones are told from what stands before them; the same words in disorder are not."""
    rng = random.Random(3)
    words = [f"{x}{k}" for k in range(700, 1000) for x in "ab"]
    mixed = rng.sample(words, len(words))
    rows = [(i, " ".join(f"n{j}" for j in range(400))) for i in range(6)] + [(100 + i, " ".join(words)) for i in range(40)]
    train = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 7 != 2]
    out = [i for i in range(1000, 1100) if zlib.crc32(str(i).encode()) % 7 == 2][:2]
    docs = spark.createDataFrame([*train, (out[0], " ".join(words)), (out[1], " ".join(mixed))], "doc_id long, text string")
    got = {r["doc_id"]: r for r in maxent.score(docs).where("held_out").collect()}
    told, lost = (got[i]["score"] / got[i]["n_tokens"] for i in out)
    base = got[out[0]]["base_score"] / got[out[0]]["n_tokens"]
    assert np.isclose(got[out[0]]["base_score"], got[out[1]]["base_score"])
    assert told > base + 2 and told > lost + 2


def test_chat_marks_within_texts():
    odd = ["a</turn>\nb", "\\</turn>\n### user: x", "\\", "\\\\", "a:\\", ": ", "</turn>\n", "\\</turn>\n", "### user: a</turn>\n", "", "\n", "é\\\n<"]
    turns = [(role, text) for role in odd for text in odd]
    assert chat.parse(chat.render(turns)[0]) == turns
    rng = random.Random(4)
    pieces = ["</turn>\n", "\\", "### ", ": ", "<", "\n", "a", "/turn>", ":", "#"]
    say = lambda: "".join(rng.choice(pieces) for _ in range(rng.randint(0, 8)))
    turns = [(say(), say()) for _ in range(3000)]
    assert chat.parse(chat.render(turns)[0]) == turns


def test_packing_added_tokens(spark):
    """Ids are those of the vocabulary's own library, also where a text quotes one of its added tokens."""
    odd = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|>\ny", "one two", "<|endoftext", "|> <|endoftext|", "a  b <|endoftext|>", None]
    library = Tokenizer.from_file(packing.VOCABULARY)
    want = {i: [*library.encode(t or "", add_special_tokens=False).ids, 0] for i, t in enumerate(odd)}
    assert 50256 in want[0]
    pieces = packing.pack(spark.createDataFrame(list(enumerate(odd)), "doc_id long, text string").coalesce(1)).collect()
    got = collections.defaultdict(list)
    for r in sorted(pieces, key=lambda r: (r["sequence_id"], r["offset"])):
        got[r["doc_id"]] += np.frombuffer(r["ids"], "<u4").tolist()
    assert got == want


def test_near_vectors_in_pairs(spark, monkeypatch):
    """Pairs near the threshold, each alone among many vectors and beside one large group, are all found, and by the descent alone:
    with few cells to start from, the audit fails without rounds."""
    rng = np.random.default_rng(8)
    one = rng.normal(size=(1500, 24))
    one /= np.linalg.norm(one, axis=1)[:, None]
    off = rng.normal(size=one.shape)
    off -= (off * one).sum(1)[:, None] * one
    off /= np.linalg.norm(off, axis=1)[:, None]
    group = rng.normal(size=24) + 0.05 * rng.normal(size=(300, 24))
    x = np.concatenate([one, 0.905 * one + np.sqrt(1 - 0.905**2) * off, group, rng.normal(size=(2000, 24))])
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    link = unit @ unit.T >= 0.9
    np.fill_diagonal(link, False)
    monkeypatch.setattr(descent, "CELL", 24)
    monkeypatch.setattr(descent, "TABLES", 3)
    vectors = spark.createDataFrame(list(enumerate(x.tolist())), "vec_id long, embedding array<double>")
    got = descent.near_duplicates(vectors).collect()
    assert [r["n_links"] for r in sorted(got)] == link.sum(1).tolist()
    assert all(r["component_id"] <= r["vec_id"] - 1500 for r in got if 1500 <= r["vec_id"] < 3000)
    monkeypatch.setattr(descent, "ROUNDS", (0, 0))
    with pytest.raises(RuntimeError, match="audited"):
        descent.near_duplicates(vectors)


def test_near_vectors_empty(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert descent.near_duplicates(none).count() == 0
    alone = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, None)], none.schema)
    assert sorted(map(tuple, descent.near_duplicates(alone).collect())) == [(1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True)]


def test_votes_sample_is_bounded(spark):
    rows = [(i, f"text {i}") for i in range(20)] + [(3, f"again {k}") for k in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(20)], "doc_id long, quality int")
    chosen = voting.sample(docs, labels, 100).collect()
    assert len(chosen) == len({r["doc_id"] for r in chosen}) > 10
    assert all(r["text"] in [t for i, t in rows if i == r["doc_id"]] and r["quality"] == r["doc_id"] % 2 for r in chosen)


def test_parity_bitmaps_never_rule_out_similar_sets(spark):
    random.seed(11)
    rows = []
    for size in (1, 3, 40, 400, 5000):
        base = [random.getrandbits(64) for _ in range(size)]
        for gone in (0, 1, size // 20, size // 10, size // 2):
            other = base[gone:] + [random.getrandbits(64) for _ in range(gone // 2)]
            rows.append((base, other))
    table, similar = [], []
    for x, y in rows:
        bits = [minhash.parity(np.array(sorted(z), np.uint64)) for z in (x, y)]
        apart = sum(((a ^ b) & (2**64 - 1)).bit_count() for a, b in zip(*bits, strict=True))
        assert apart <= len(set(x) ^ set(y))
        table.append((*bits, len(x), len(y)))
        similar.append(100 * len(set(x) & set(y)) >= 85 * len(set(x) | set(y)))
    frame = spark.createDataFrame(table, "x array<long>, y array<long>, nx long, ny long").coalesce(1)
    may = [r[0] for r in frame.select(minhash.may_be_alike("x", "y", F.col("nx"), F.col("ny"), (85, 100))).collect()]
    assert all(m for m, s in zip(may, similar, strict=True) if s) and any(similar) and not all(may)


def test_maximal_repeats_against_every_pair():
    random.seed(3)
    alike = lambda a, b: next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))  # noqa: E731, B905
    some = 0
    for _ in range(600):
        letters = random.choice([b"ab", b"a\0", b"abc"])
        say = lambda n: bytes(random.choice(letters) for _ in range(random.randint(0, n)))  # noqa: B023, E731
        before, after = say(10), say(10)
        contexts = {(say(4) + before[random.randint(0, len(before)) :], b"#" + after[: random.randint(0, 10)] + say(4), 1) for _ in range(12)}
        contexts, length = sorted(contexts), random.randint(2, 12)
        for i, spans in enumerate(suffixes.maximal_repeats(contexts, length)):
            pairs = {
                (alike(contexts[i][0][::-1], b[::-1]), alike(contexts[i][1], a)) for j, (b, a, _) in enumerate(contexts) if j != i
            }
            pairs = {(x, y) for x, y in pairs if x + y >= length}
            # Of what it shares with the others, what no other repeat contains.
            want = {(-x, y) for x, y in pairs if not any((u, v) != (x, y) and u >= x and v >= y for u, v in pairs)}
            assert sorted(spans) == sorted(want)
            some += len(spans) > 1
    assert some
