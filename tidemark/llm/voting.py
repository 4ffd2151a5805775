"""Quality classification by the votes of the nearest labelled documents.

A document's terms are its words and its words' shapes (letter case, digits, marks, repetition), hashed, weighted by the share they
make of the text and by rarity over the whole corpus. A truncated singular value decomposition of a bounded sample of labelled
documents gives the latent space; every document is projected, compared exactly with every labelled vector, and scored by
its nearest ones' labels, weighted by similarity.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.shipping import ship_package
from tidemark.llm.tokenizing import spread
from tidemark.llm.words import Words, mix, slices, split_words

#: Hashed terms, dimensions of the latent space, labelled documents fitted on at most, votes of a document.
TERMS, DIMENSIONS, LABELLED, VOTES = 1 << 14, 48, 5000, 15
#: Weight of word terms beside shape terms.
WORD_WEIGHT = 0.5
CUT = 0.3
#: Words whose shapes are worked out at once.
SHAPED = 1 << 14

_HALF = TERMS // 2
_SHAPE = np.arange(256)
_SHAPE[97:123] = _SHAPE[128:256] = 97
_SHAPE[65:91] = 65
_SHAPE[48:58] = 48
_SHAPE_VALUE = mix(np.arange(1, 257, dtype=np.uint64))[_SHAPE]


def shape_hashes(words: Words, block: int = SHAPED) -> np.ndarray:
    """Hash of each word's run of character kinds, equal neighbours taken once; 1 for a word equal to the one before.

    Worked out for so many words at a time, as it takes some fifty bytes of memory for one of text.
    """
    starts = range(0, max(len(words.start), 1), block)
    return np.concatenate([_shapes(words.data, words.start[k : k + block], words.end[k : k + block]) for k in starts])


def _shapes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    size = end - start
    at = spread(start, size)
    kinds = _SHAPE[data[at]]
    begins = np.cumsum(size) - size
    fresh = np.append(True, kinds[1:] != kinds[:-1])
    fresh[begins] = True
    run = np.cumsum(fresh)
    place = (run - run[begins].repeat(size)).astype(np.uint64)
    value = np.where(fresh, mix(_SHAPE_VALUE[data[at]] + place), np.uint64(0))
    return np.add.reduceat(value, begins) if len(begins) else np.zeros(0, np.uint64)


def terms(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, term and weight (square root of its share of the text's words) of each distinct term of each text."""
    words = split_words(batch.column("text"))
    n = np.bincount(words.text, minlength=batch.num_rows)
    hashes = words.hashes(True)
    word = (hashes % np.uint64(_HALF)).astype(np.int64)
    shape = (shape_hashes(words) % np.uint64(_HALF - 1)).astype(np.int64) + _HALF + 1
    again = np.append(False, (hashes[1:] == hashes[:-1]) & (words.text[1:] == words.text[:-1]))[: len(hashes)]
    shape[again] = _HALF
    code, count = np.unique(np.concatenate([words.text * TERMS + word, words.text * TERMS + shape]), return_counts=True)
    text, term = np.divmod(code, TERMS)
    weight = np.sqrt(count / np.maximum(n[text], 1))
    return text, term, np.where(term < _HALF, WORD_WEIGHT * weight, weight)


def rarity(docs: DataFrame) -> np.ndarray:
    """Inverse document frequency of each hashed term over all documents."""
    ship_package()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, rows = np.zeros(TERMS, np.int64), 0
        for batch in slices(batches, "text", 2 << 20):
            seen += np.bincount(terms(batch)[1], minlength=TERMS)
            rows += batch.num_rows
        if rows:
            yield pa.record_batch({"term": pa.array(np.arange(-1, TERMS)), "n": pa.array(np.append(rows, seen))})

    summed = docs.select("text").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    rows = summed.toPandas().set_index("term")["n"]  # one row per hashed term, whatever the corpus
    return np.log1p(rows.get(-1, 0) / (1.0 + rows.reindex(range(TERMS), fill_value=0).to_numpy(float)))


def _project(batch: pa.RecordBatch, idf: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """Unit vectors of the texts in the latent space; zero for a text without terms."""
    text, term, weight = terms(batch)
    out = np.zeros((batch.num_rows, basis.shape[1]), np.float32)
    value = (weight * idf[term]).astype(np.float32)
    for low in range(0, len(term), 1 << 17):
        part = slice(low, low + (1 << 17))
        starts = np.flatnonzero(np.append(True, text[part][1:] != text[part][:-1]))
        out[text[part][starts]] += np.add.reduceat(basis[term[part]] * value[part, None], starts, axis=0)
    norm = np.sqrt((out * out).sum(1, keepdims=True))
    return out / np.where(norm > 0, norm, 1)


def held_out(column: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, bound: int) -> pa.Table:
    """text and quality of the `bound` labelled documents that are not held out and come first by hash of their id.

    One row per doc_id: of rows that share one, that whose text has the least hash."""
    marked = labels.where(~held_out() & F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
    marked = marked.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    chosen = marked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    least = F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text")
    return rows.groupBy("doc_id").agg(least, F.min("quality").alias("quality"))


def fit(texts: DataFrame, idf: np.ndarray, dimensions: int = DIMENSIONS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Basis (terms x dimensions), labelled unit vectors and their labels, from the bounded sample."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            text, term, weight = terms(batch)
            edges = np.searchsorted(text, np.arange(batch.num_rows + 1))
            spans = list(zip(edges, edges[1:], strict=False))
            yield pa.record_batch(
                {
                    "doc_id": batch.column("doc_id"), "quality": batch.column("quality"),
                    "term": pa.array([term[a:b].astype("<u2").tobytes() for a, b in spans], pa.binary()),
                    "value": pa.array([(weight * idf[term])[a:b].astype("<f4").tobytes() for a, b in spans], pa.binary()),
                }
            )

    ids = texts.schema["doc_id"].dataType.simpleString()
    kinds = f"doc_id {ids}, quality {texts.schema['quality'].dataType.simpleString()}, term binary, value binary"
    rows = texts.mapInArrow(run, kinds).toPandas().sort_values(["doc_id", "term"])
    label = rows["quality"].to_numpy(np.float32)
    size = rows["term"].map(len).to_numpy(np.int64) // 2
    term = np.frombuffer(b"".join(rows["term"]), "<u2").astype(np.int64)
    value = np.frombuffer(b"".join(rows["value"]), "<f4")
    text = np.repeat(np.arange(len(size)), size)

    def times(right: np.ndarray) -> np.ndarray:
        out = np.zeros((len(size), right.shape[1]), np.float32)
        for low in range(0, len(term), 1 << 17):
            part = slice(low, low + (1 << 17))
            starts = np.flatnonzero(np.append(True, text[part][1:] != text[part][:-1]))
            out[text[part][starts]] += np.add.reduceat(right[term[part]] * value[part, None], starts, axis=0)
        return out

    by_term = np.argsort(term, kind="stable")

    def transposed(left: np.ndarray) -> np.ndarray:
        out = np.zeros((TERMS, left.shape[1]), np.float32)
        for low in range(0, len(term), 1 << 17):
            part = by_term[low : low + (1 << 17)]
            starts = np.flatnonzero(np.append(True, term[part][1:] != term[part][:-1]))
            out[term[part][starts]] += np.add.reduceat(left[text[part]] * value[part, None], starts, axis=0)
        return out

    # Randomised subspace iteration: a few products with the sparse matrix find its leading right singular vectors.
    basis = np.random.default_rng(0).standard_normal((TERMS, dimensions)).astype(np.float32)
    for _ in range(4 if len(term) else 0):
        basis = np.linalg.qr(transposed(times(basis)))[0].astype(np.float32)
    vectors = times(basis)
    norm = np.sqrt((vectors * vectors).sum(1, keepdims=True))
    return basis, vectors / np.where(norm > 0, norm, 1), label


def vote(vectors: np.ndarray, labelled: np.ndarray, label: np.ndarray, votes: int = VOTES, block: int = 512) -> np.ndarray:
    """Mean label of the nearest, weighted by similarity; 0.5 where none is at all similar."""
    out = np.full(len(vectors), 0.5)
    if not len(labelled):
        return out
    k = min(votes, len(labelled))
    for low in range(0, len(vectors), block):
        sims = vectors[low : low + block] @ labelled.T
        near = np.argpartition(sims, -k, axis=1)[:, -k:]
        weight = np.maximum(np.take_along_axis(sims, near, 1), 0).astype(float) ** 4
        total = weight.sum(1)
        mean = (weight * label[near]).sum(1) / np.where(total > 0, total, 1)
        out[low : low + block] = np.where(total > 0, mean, 0.5)
    return np.clip(out, 0, 1)


def classify(docs: DataFrame, labels: DataFrame, bound: int = LABELLED, cut: float = CUT) -> DataFrame:
    """One row per row of docs: doc_id, held_out, score (0 to 1), predicted (1 if score >= cut).

    Learns from at most `bound` labelled rows, none of them held out (crc32(doc_id) mod 5 is 0); only texts enter a score. Empty
    and null texts, and all texts where nothing is labelled, have score 0.5. A doc_id labelled twice has its lowest label. Rows
    are scored one by one, so repeated and null ids and very long texts are like any other; other columns are ignored.
    """
    scored = _scored(docs.select("doc_id", "text"), labels, bound, False)
    return scored.select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= cut).cast("int").alias("predicted")
    )


def accepted(docs: DataFrame, labels: DataFrame, bound: int = LABELLED, cut: float = CUT) -> DataFrame:
    """The rows of docs, all columns, that `classify` predicts to be good."""
    return _scored(docs, labels, bound, True).where(F.col("score") >= cut).select("row.*")


def _scored(docs: DataFrame, labels: DataFrame, bound: int, carry: bool) -> DataFrame:
    """doc_id and score of each row of docs and, if asked for, the row itself."""
    ship_package()
    idf = rarity(docs)
    share = docs.sparkSession.sparkContext.broadcast((idf, *fit(sample(docs, labels, bound), idf)))
    kind = docs.schema["doc_id"].dataType.simpleString()
    row = f", row {docs.schema.simpleString()}" if carry else ""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idf, basis, labelled, label = share.value
        for batch in slices(map(with_text, batches) if carry else batches, "text", 2 << 20):
            scores = vote(_project(batch, idf, basis), labelled, label)
            out = {"doc_id": batch.column("doc_id"), "score": pa.array(scores)}
            yield pa.record_batch(out | ({"row": batch.column("row")} if carry else {}))

    def with_text(batch: pa.RecordBatch) -> pa.RecordBatch:
        """The text is that within the row: it travels once."""
        return batch.append_column("text", batch.column("row").field("text"))

    # Packed away, other columns keep out of the way of names used here.
    columns = ["doc_id", F.struct("*").alias("row") if carry else "text"]
    return docs.select(*columns).mapInArrow(run, f"doc_id {kind}, score double{row}")
