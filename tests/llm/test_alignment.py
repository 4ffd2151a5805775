"""Alignment of two tokenizers against loops over bytes, with bitmaps read back."""

import collections
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tidemark.llm import alignment


@pytest.fixture(scope="module")
def texts():
    random.seed(11)
    words = ["the", "of", "naïve", "Straße", "漢字かな", "tokenization", "<|endoftext|>", "</s>", "x1y2", "it's", "\U0001f600\U0001f601", "…", "foo_bar"]
    say = lambda n: " ".join(random.choice(words) for _ in range(n))
    odd = [None, "", " ", "\n", "a  b", " a", "a ", "\ta\r\nb", "▁", "a ▁b", "\x00", "é" * 50, "a\xa0b", "    deep", "x" * 400]
    rows = list(enumerate(odd + [say(random.randint(1, 40)) for _ in range(120)] + ["the the the of the"] * 3))
    return rows + [(5, "the of"), (5, "the of"), (None, "the of"), (999, say(500))]


def plainly(texts):
    a_own = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a_own.encode_special_tokens = True
    b_own = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in shown} | {chr(256 + n): b for n, b in enumerate(b for b in range(256) if b not in shown)}
    a_bytes = lambda i: bytes(letters[c] for c in a_own.id_to_token(i))

    def b_bytes(i):
        piece = b_own.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if b_own.is_byte(i) else piece.replace("▁", " ").encode()

    held, documents = [], collections.Counter()
    for doc_id, text in texts:
        a = a_own.encode(f" {text}", add_special_tokens=False).ids if text else []
        b = b_own.encode(text) if text else []
        whole = f" {text}".encode()
        if not text or b"".join(map(a_bytes, a)) != whole or b"".join(map(b_bytes, b)) != whole:
            a, b = [], []
        spans = []
        for ids, spelled in ((a, a_bytes), (b, b_bytes)):
            at, own = 0, []
            for i in ids:
                own.append((i, at, at + len(spelled(i))))
                at = own[-1][2]
            spans.append(own)
        links = [(x, y) for x, s, e in spans[0] for y, t, f in spans[1] if s < f and t < e]
        cuts = sorted({e for _, _, e in spans[0]} & {e for _, _, e in spans[1]})
        groups, low = [], 0
        for cut in cuts:
            groups.append("|".join(",".join(str(i) for i, s, e in own if s >= low and e <= cut) for own in spans))
            low = cut
        held.append((doc_id, len(a), len(b), len(groups), links, ";".join(groups)))
        documents.update(set(links))
    highest = collections.Counter()
    for (x, _), n in documents.items():
        highest[x] = max(highest[x], n)
    return documents, [
        (i, na, nb, ng, len(links), sum(documents[p] == highest[p[0]] for p in links), sum(documents[p] for p in links),
         hashlib.sha256(g.encode()).hexdigest() if g else "", g)
        for i, na, nb, ng, links, g in held
    ]


def test_against_loops(spark, texts):
    frame = spark.createDataFrame([(i, t, "x", 7) for i, t in texts], "doc_id long, text string, groups string, pair int").repartition(3)
    counted, want = plainly(texts)
    for limit in (alignment.BLOCK_BYTES, 1):
        got = alignment.align(frame, groups=True, block_bytes=limit).collect()
        assert collections.Counter(map(tuple, got)) == collections.Counter(want)
    index = alignment.blocks(frame)
    counts = alignment.pair_counts(index, 32_000).collect()
    assert {(r["a"], r["b"]): r["n_docs"] for r in counts} == counted
    assert sum(r["n_links"] for r in counts) == sum(w[4] for w in want)
    assert sum(1 for w in want if w[1] == 0) >= 4


def test_long_texts_are_cut_where_no_token_reaches(texts):
    a, b = alignment.ByteVocabulary(alignment.A_VOCABULARY), alignment.PieceVocabulary(alignment.B_VOCABULARY)
    text = " ".join(t for _, t in texts if t) + "  two   three \n\n four " * 5
    for limit in (1, 7, 100):
        cut = alignment.parts(text, limit)
        assert " ".join(cut) == text and len(cut) > 10
        for vocabulary in (a, b):
            assert vocabulary.encode(cut)[0].tolist() == vocabulary.encode([text])[0].tolist()


def test_bitmaps_read_back():
    rng = np.random.default_rng(1)
    for docs, n in ((1, 5), (40, 3000), (5000, 20_000)):
        pair, doc = rng.zipf(1.3, n) % 50_000, rng.integers(0, docs, n)
        want = collections.Counter(zip(pair.tolist(), doc.tolist(), strict=True))
        got, dense = {}, 0
        for rows in alignment.bitmaps(pair << 16 | doc, docs):
            held, sizes = rows.column("n_docs").to_numpy(), [len(x.as_py()) for x in rows.column("docs")]
            dense += sum(s != 2 * k for s, k in zip(sizes, held.tolist(), strict=True))
            row, at, often = alignment.postings(held, rows.column("docs"), rows.column("planes"))
            names = rows.column("pair").to_numpy()[row]
            got |= dict(zip(zip(names.tolist(), at.tolist(), strict=True), often.tolist(), strict=True))
        assert got == dict(want)
        assert docs == 1 or dense


def test_empty_table(spark):
    assert alignment.align(spark.createDataFrame([], "doc_id string, text string")).collect() == []
