"""Language-model scoring by a hashed maximum-entropy model with a class-factored softmax.

The HELD most frequent words stand by rank in classes of classes, sixteen children to a node and LEVELS levels; all other words
are one more class at the root, and are told apart by their counts. Each step down is a softmax over the children of a
node. Its weights are sums over features of the history, hashed into the rows that the node has in the feature table: the word
before (n-gram), the word before that (skip), and the pair. Before training every step has the shares of the add-one
counts, so that the model starts as the unigram it is compared with.

Training: every task counts, over all tokens of its documents, what each feature row has observed and what the model expects
of it; the sums of all tasks are added up on Spark, and each weight moves along the scaled gradient, the logarithm of
observed over expected counts (both with PRIOR more tokens as the start has them). Scoring works on arrays of all tokens of a slice.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.shipping import ship_package
from tidemark.llm.staging import written
from tidemark.llm.words import Words, mix, slices, split_words

#: Children of a node, levels of nodes, and held words: those whose counts and ranks every task has. The last child of
#: the root stands for all other words.
MEMBERS, LEVELS = 16, 4
HELD = (MEMBERS - 1) * MEMBERS ** (LEVELS - 1)
#: Rows of the feature table for a corpus of n tokens: this many times the square root of n, within these bounds: the table is
#: broadcast, 32 bytes a row.
ROWS_PER_ROOT, LEAST_ROWS, MOST_ROWS = 64, 1 << 17, 1 << 21
#: How far a row moves towards its observed counts: of the word before, the one before that, and the pair.
RATES = (0.6, 0.4, 0.6)
#: Tokens of the start that every row is taken to have seen besides its own.
PRIOR = 32.0
ROUNDS = 1

END = int(np.uint64(0x5E17D06E5E17D06E).view(np.int64))
START = np.uint64(0x57A27057A27057A2)
_MIXED = np.uint64(0xD6E8FEB86659FD93)
#: Tokens handled at once within a slice.
_CHUNK = 1 << 16


def token_keys(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, Words]:
    """Keys of all tokens of the texts, each text's words and then the end, and the text of each token."""
    words = split_words(batch.column("text"))
    n, rows = len(words.text), batch.num_rows
    at = np.arange(n) + words.text
    keys, text = np.full(n + rows, END, np.int64), np.empty(n + rows, np.int64)
    keys[at] = words.hashes(True).view(np.int64)
    ends = words.bounds()[1:] + np.arange(rows)
    text[at], text[ends] = words.text, np.arange(rows)
    return keys, text, words


def held_out(column: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % 7 == 2, F.lit(False))


def word_counts(training: DataFrame) -> DataFrame:
    """key, c: the count of every word, and of the end, in the training texts; written."""
    ship_package()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 4 << 20):
            keys, n = np.unique(token_keys(batch)[0], return_counts=True)
            yield pa.record_batch({"key": pa.array(keys), "n": pa.array(n)})

    found = training.select("text").mapInArrow(run, "key long, n long")
    return written(found.groupBy("key").agg(F.sum("n").alias("c")), "word-counts")


@dataclass
class Vocabulary:
    """The HELD most frequent words by sorted key, the rank and count of each, and the corpus's sums."""

    keys: np.ndarray
    ranks: np.ndarray
    counts: np.ndarray
    tokens: int
    distinct: int

    @property
    def rest(self) -> int:
        """Tokens of the words that are not held, one more for each such word, and one for all that were never seen."""
        return self.tokens - int(self.counts.sum()) + self.distinct - len(self.keys) + 1

    def look(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and count of each key; HELD and -1 for a word that is not held."""
        if not len(self.keys):
            return np.full(len(keys), HELD), np.full(len(keys), -1)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        known = self.keys[at] == keys
        return np.where(known, self.ranks[at], HELD), np.where(known, self.counts[at], -1)


def vocabulary(counts: DataFrame) -> Vocabulary:
    sums = counts.agg(F.sum("c").alias("n"), F.count("*").alias("v")).first()
    top = counts.orderBy(F.desc("c"), "key").limit(HELD).toPandas()  # HELD rows at most
    keys, n = top["key"].to_numpy(np.int64), top["c"].to_numpy(np.int64)
    order = np.argsort(keys)
    return Vocabulary(keys[order], order.astype(np.int64), n[order], sums["n"] or 0, sums["v"])


def histories(keys: np.ndarray, text: np.ndarray) -> list[np.ndarray]:
    """Hash of each feature's history per token: the word before, the one before that, both; START stands before a text."""
    keys = keys.view(np.uint64)
    first = np.append(True, text[1:] != text[:-1])[: len(text)]
    one = np.where(first, START, np.append(START, keys[:-1])[: len(keys)])
    second = first | np.append(True, first[:-1])[: len(first)]
    two = np.where(second, START, np.concatenate([[START, START], keys[:-2]]).astype(np.uint64)[: len(keys)])
    near = mix(one * _MIXED + np.uint64(1))
    return [near, mix(two * _MIXED + np.uint64(2)), mix(near * _MIXED + two)]


class Model:
    """The start's shares by node, and the feature table with the rows that each node has in it per feature."""

    def __init__(self, known: Vocabulary):
        leaves = np.zeros(MEMBERS**LEVELS)
        leaves[known.ranks] = known.counts + 1
        leaves[HELD] = known.rest
        grids = [leaves.reshape(MEMBERS**k, MEMBERS, -1).sum(2) for k in range(LEVELS)]
        # Below the root only the classes of held words have nodes.
        grids = [grids[0], *(g[: (MEMBERS - 1) * MEMBERS ** (k - 1)] for k, g in enumerate(grids) if k)]
        self.first = np.cumsum([0, *map(len, grids)])
        mass = np.concatenate(grids)
        whole = mass.sum(1, keepdims=True)
        self.share = np.where(whole > 0, mass / np.where(whole > 0, whole, 1), 1 / MEMBERS)
        with np.errstate(divide="ignore"):
            self.start = np.log(self.share).astype(np.float32).clip(-60)
        rows = min(MOST_ROWS, max(LEAST_ROWS, int(ROWS_PER_ROOT * np.sqrt(known.tokens))))
        # A node's rows are in proportion to its tokens, at least one per feature.
        size = np.maximum(1, rows / len(RATES) * whole[:, 0] / max(1.0, whole.sum())).astype(np.int64)
        self.size = size.astype(np.uint64)
        self.begin = np.cumsum(size) - size
        self.rows = int(size.sum())
        self.table = np.zeros((self.rows * len(RATES), MEMBERS), np.float16)

    def node_of(self, row: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.begin, row % self.rows, side="right") - 1

    def steps(self, rank: np.ndarray, hashed: list[np.ndarray]) -> Iterator[tuple]:
        """From the root down: which of the tokens take a step here, their node, the child taken, and their histories."""
        chosen, own = np.arange(len(rank)), hashed
        for k in range(LEVELS):
            if k == 1:
                chosen = np.flatnonzero(rank < HELD)
                rank, own = rank[chosen], [h[chosen] for h in hashed]
            yield chosen, self.first[k] + (rank >> 4 * (LEVELS - k)), (rank >> 4 * (LEVELS - 1 - k)) & (MEMBERS - 1), own

    def places(self, node: np.ndarray, hashed: list[np.ndarray]) -> list[np.ndarray]:
        """The table row of each feature: the upper half of the hash, taken as a fraction of the node's rows."""
        begin, size, half = self.begin[node], self.size[node], np.uint64(32)
        return [begin + ((h >> half) * size >> half).astype(np.int64) + k * self.rows for k, h in enumerate(hashed)]

    def weights(self, node: np.ndarray, places: list[np.ndarray]) -> np.ndarray:
        """Logarithm of each child's share but for their common sum. They stay within what a float32 can hold the power of:
        the start is at most 0, and a row moves by the logarithm of counts.
        """
        z = self.start[node]
        for place in places:
            z += self.table[place]
        return z

    def log_probability(self, rank: np.ndarray, hashed: list[np.ndarray]) -> np.ndarray:
        """Natural logarithm of each token's share; for a word that is not held that of all of them."""
        out = np.zeros(len(rank))
        for low in range(0, len(rank), _CHUNK):
            part = slice(low, low + _CHUNK)
            for chosen, node, child, own in self.steps(rank[part], [h[part] for h in hashed]):
                z = self.weights(node, self.places(node, own))
                taken = z[np.arange(len(child)), child]
                out[part][chosen] += taken - np.log(np.exp(z, out=z).sum(1))
        return out

    def gather(self, observed: np.ndarray, expected: np.ndarray | None, rank: np.ndarray, hashed: list[np.ndarray]) -> None:
        """Add what the rows observe; where it is not the start's, also what the model expects of them."""
        for low in range(0, len(rank), _CHUNK):
            part = slice(low, low + _CHUNK)
            for _, node, child, own in self.steps(rank[part], [h[part] for h in hashed]):
                places = self.places(node, own)
                if expected is not None:
                    shares = np.exp(self.weights(node, places))
                    shares /= shares.sum(1, keepdims=True)
                for place in places:
                    cell = np.sort(place * MEMBERS + child)
                    new = np.flatnonzero(np.append(True, cell[1:] != cell[:-1])[: len(cell)])
                    observed[cell[new]] += np.diff(np.append(new, len(cell))).astype(observed.dtype)
                    if expected is not None:
                        np.add.at(expected, place, shares)

    def moves(self, row: np.ndarray, observed: np.ndarray, expected: np.ndarray | None) -> np.ndarray:
        """How far each weight of the rows goes. At the start a row expects the shares of its node, for its tokens."""
        prior = PRIOR * self.share[self.node_of(row)]
        if expected is None:
            expected = observed.sum(1, keepdims=True) * prior / PRIOR
        rate = np.array(RATES)[row // self.rows][:, None]
        tiny = 1e-30  # a child that no word has is neither observed nor expected
        return rate * np.log((observed + prior + tiny) / (expected + prior + tiny))


_ROWS_OUT = 1 << 13


def train(training: DataFrame, known: Vocabulary, rounds: int = ROUNDS) -> Model:
    """Rounds of updates, each from the sums over all tokens of all tasks."""
    model = Model(known)
    context = training.sparkSession.sparkContext
    # One task per core: each ships its sums once, and reads its documents slice by slice.
    texts = training.select("text").coalesce(context.defaultParallelism)
    for number in range(rounds):
        share = context.broadcast((model, known))

        def run(batches: Iterator[pa.RecordBatch], share=share, number=number) -> Iterator[pa.RecordBatch]:
            model, known = share.value
            observed = np.zeros(model.table.size, np.int32)
            expected = np.zeros(model.table.shape, np.float32) if number else None
            for batch in slices(batches, "text", 4 << 20):
                keys, text, _ = token_keys(batch)
                model.gather(observed, expected, known.look(keys)[0], histories(keys, text))
            observed = observed.reshape(-1, MEMBERS)
            touched = np.flatnonzero(observed.any(1))
            for low in range(0, len(touched), _ROWS_OUT):
                row = touched[low : low + _ROWS_OUT]
                columns = {"row": pa.array(row), "seen": _cells(observed[row].astype("<i4"))}
                columns["due"] = pa.nulls(len(row), pa.binary()) if expected is None else _cells(expected[row].astype("<f4"))
                yield pa.record_batch(columns)

        def add(batches: Iterator[pa.RecordBatch], share=share, number=number) -> Iterator[pa.RecordBatch]:
            """Rows of one number follow each other: each run of them is summed, the last one with the next batch."""
            model, (held, seen, due) = share.value[0], (np.zeros(0, np.int64), np.zeros((0, MEMBERS)), np.zeros((0, MEMBERS)))
            for batch in _and_none(batches):
                if batch is not None:
                    held = np.concatenate([held, batch.column("row").to_numpy()])
                    seen = np.concatenate([seen, _values(batch.column("seen"), "<i4")])
                    if number:
                        due = np.concatenate([due, _values(batch.column("due"), "<f4")])
                if not len(held):
                    continue
                starts = np.flatnonzero(np.append(True, held[1:] != held[:-1]))
                row, sums = held[starts], np.add.reduceat(seen, starts)
                owed = np.add.reduceat(due, starts) if number else None
                done = len(row) if batch is None else len(row) - 1
                if done:
                    step = model.moves(row[:done], sums[:done], None if owed is None else owed[:done]).astype("<f2")
                    yield pa.record_batch({"rows": pa.array([row[:done].astype("<i8").tobytes()]), "steps": pa.array([step.tobytes()])})
                held, seen = row[done:], sums[done:]
                due = owed[done:] if number else due

        sums = texts.mapInArrow(run, "row long, seen binary, due binary").repartition("row").sortWithinPartitions("row")
        # MOST_ROWS of them at most, thousands to a record.
        for rows, steps in zip(*sums.mapInArrow(add, "rows binary, steps binary").toArrow().columns, strict=True):
            model.table[np.frombuffer(rows.as_buffer(), "<i8")] += np.frombuffer(steps.as_buffer(), "<f2").reshape(-1, MEMBERS)
        share.unpersist()
    return model


def _cells(values: np.ndarray) -> pa.Array:
    return pa.FixedSizeBinaryArray.from_buffers(
        pa.binary(values.dtype.itemsize * MEMBERS), len(values), [None, pa.py_buffer(np.ascontiguousarray(values).tobytes())]
    ).cast(pa.binary())


def _values(column: pa.Array, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, MEMBERS).astype(float)


def _and_none(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from batches
    yield None


def score_slice(model: Model, known: Vocabulary, batch: pa.RecordBatch) -> tuple[dict[str, np.ndarray], dict[str, np.ndarray]]:
    """Per text: n_tokens, known, base, score but for the share of other words in their class. Per text and other word: text, key, n."""
    keys, text, _ = token_keys(batch)
    rows = batch.num_rows
    rank, count = known.look(keys)
    log = model.log_probability(rank, histories(keys, text))
    held = count >= 0
    base = np.where(held, np.log10((np.maximum(count, 0) + 1) / (known.tokens + known.distinct + 1)), 0.0)
    total = lambda x: np.bincount(text, x, rows)
    per_text = {
        "n": np.bincount(text, minlength=rows), "known": total(held).astype(np.int64), "base": total(base),
        "score": total(log / np.log(10)),
    }
    rare = np.flatnonzero(~held)
    order = rare[np.lexsort((keys[rare], text[rare]))]
    new = np.append(True, (keys[order][1:] != keys[order][:-1]) | (text[order][1:] != text[order][:-1]))[: len(order)]
    at = np.flatnonzero(new)
    n = np.diff(np.append(at, len(order)))
    return per_text, {"text": text[order][at], "key": keys[order][at], "n": n}


def score(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """One row per row of docs: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Learns from the rows whose crc32(doc_id) mod 7 is not 2 (a null id is among them). base_score is the add-one unigram log10
    probability, score the model's. A null text counts as empty: one token, the end. Words are told apart by 64-bit hashes.
    Every row has its own result, repeated ones too; other columns are ignored. With nothing to learn from, all tokens
    are unknown and score is base_score.
    """
    ship_package()
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    training = docs.where(~held_out())
    counts = word_counts(training)
    known = vocabulary(counts)
    share = spark.sparkContext.broadcast((train(training, known, rounds), known))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (model, known), part, done = share.value, TaskContext.get().partitionId(), 0
        for batch in slices(batches, "text", 2 << 20):
            texts, rare = score_slice(model, known, batch)
            rows, more = batch.num_rows, len(rare["n"])
            yield pa.record_batch(
                {
                    "part": pa.array(np.full(rows, part, np.int64)), "at": pa.array(np.arange(done, done + rows)),
                    "doc_id": batch.column("doc_id"), "key": pa.nulls(rows, pa.int64()),
                    **{name: pa.array(values) for name, values in texts.items()},
                }
            )
            if more:
                yield pa.record_batch(
                    {
                        "part": pa.array(np.full(more, part, np.int64)), "at": pa.array(rare["text"] + done),
                        "doc_id": pa.nulls(more, batch.column("doc_id").type), "key": pa.array(rare["key"]),
                        "n": pa.array(rare["n"]), "known": pa.nulls(more, pa.int64()),
                        "base": pa.nulls(more, pa.float64()), "score": pa.nulls(more, pa.float64()),
                    }
                )
            done += rows

    schema = f"part long, at long, doc_id {kind}, key long, n long, known long, base double, score double"
    parts = written(docs.mapInArrow(run, schema), "scored")
    whole = parts.where("key IS NULL").drop("key")
    c = F.coalesce("c", F.lit(0))
    rare = parts.where("key IS NOT NULL").select("part", "at", "key", "n").join(counts, "key", "left").select(
        "part", "at", F.lit(None).cast(kind).alias("doc_id"), F.lit(None).cast("long").alias("n"),
        F.when(c > 0, F.col("n")).otherwise(F.lit(0)).alias("known"),
        (F.col("n") * F.log10((c + 1) / F.lit(float(known.tokens + known.distinct + 1)))).alias("base"),
        (F.col("n") * F.log10((c + 1) / F.lit(float(known.rest)))).alias("score"),
    )
    each = whole.unionByName(rare).groupBy("part", "at").agg(
        F.max("doc_id").alias("doc_id"), *(F.sum(x).alias(x) for x in ("n", "known", "base", "score"))
    )
    return each.select(
        "doc_id", held_out().alias("held_out"), F.col("n").alias("n_tokens"), F.col("known").alias("n_known"),
        F.lit(known.tokens).cast("long").alias("train_tokens"), F.col("base").alias("base_score"), "score",
    )
