"""Passages of at least `length` units (bytes or words) that start at two places or more: the search common to two operators.

Every window of `length` units holds an anchor: a run of `width` units whose hash is least in some window around it
(winnowing). Equal windows hold equal anchors at equal distances. So a window can only repeat where its anchor does, and what
surrounds equal anchors, `length` units to either side at most (a context), is all there is to compare. Contexts are counted
by hash first: equal ones are one, a third of all rows having the same passage are one row here. Different contexts of one
anchor meet in one group, which a solver takes apart; an anchor with very many different contexts is dealt out by the
windows in them. Results go back to the documents by join.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.shipping import ship_package
from tidemark.llm.staging import written
from tidemark.llm.words import mix, prefix_hash, slices, span_hash

#: Different contexts of one anchor that a solver takes at once.
CROWD = 200

#: Units of the texts of a batch: values (uint64 for hashing), what a context stores of each, and each text's bounds.
Units = Callable[[pa.Array], tuple[np.ndarray, np.ndarray, np.ndarray]]
#: From (contexts as (left, right, copies), length): per context the spans, relative to the anchor, that others share.
Solver = Callable[[list[tuple[bytes, bytes, int]], int], list[list[tuple[int, int]]]]


def _sliding(x: np.ndarray, width: int, best: np.ufunc, forward: bool) -> np.ndarray:
    """best of each run of `width` from (forward) or up to each position; runs are cut at the ends."""
    out, done = x.copy(), 1
    while done < width:
        step = min(done, width - done)
        if step >= len(out):
            step = len(out) - 1
            if step <= 0:
                break
        if forward:
            out[:-step] = best(out[:-step], out[step:])
        else:
            out[step:] = best(out[step:], out[:-step])
        done += min(done, width - done)
    return out


def find_anchors(values: np.ndarray, bounds: np.ndarray, length: int, width: int) -> tuple[np.ndarray, ...]:
    """Of each anchor: hash, text, position, units to the left and right that its context holds, hash of the context."""
    n = len(values)
    none = tuple(np.zeros(0, t) for t in (np.uint64, np.int64, np.int64, np.int64, np.int64, np.uint64))
    if n < length:
        return none
    prefix = prefix_hash(values)
    start = np.arange(n - width + 1)
    grams = np.full(n, np.iinfo(np.uint64).max)
    grams[: len(start)] = span_hash(prefix, start, start + width) >> np.uint64(1)
    for k in range(1, width):  # grams that reach into the next text
        cut = bounds[1:] - k
        grams[cut[(cut >= 0) & (bounds[1:] - bounds[:-1] >= k)]] = np.iinfo(np.uint64).max
    window = length - width + 1
    least = _sliding(grams, window, np.minimum, True)
    at = np.flatnonzero((_sliding(least, window, np.maximum, False) == grams) & (grams != np.iinfo(np.uint64).max))
    text = np.searchsorted(bounds, at, side="right") - 1
    fits = (bounds[text + 1] - bounds[text]) >= length
    at, text = at[fits], text[fits]
    left = np.minimum(at - bounds[text], length - width)
    right = np.minimum(bounds[text + 1] - at, length)
    context = mix(span_hash(prefix, at - left, at + right) + left.astype(np.uint64))
    return grams[at], text, at - bounds[text], left, right, context


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _repeated(docs: DataFrame, units: Units, length: int, width: int) -> DataFrame:
    """Anchors that occur twice or more: h, context, doc_id, mark, at, left, right; written."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            values, _, bounds = units(batch.column("text"))
            h, text, at, left, right, context = find_anchors(values, bounds, length, width)
            if len(h):
                row = pa.array(text)
                yield pa.record_batch(
                    {
                        "h": _signed(h), "context": _signed(context), "doc_id": batch.column("doc_id").take(row),
                        "mark": batch.column("mark").take(row), "at": pa.array(at.astype(np.int32)),
                        "left": pa.array(left.astype(np.int32)), "right": pa.array(right.astype(np.int32)),
                    }
                )

    schema = f"h long, context long, doc_id {kind}, mark long, at int, left int, right int"
    anchors = written(docs.mapInArrow(run, schema), "anchors")
    # Written, so that both sides of the join come straight from a shuffle: then Spark splits an anchor that very many texts have.
    often = written(anchors.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h"), "often")
    return written(anchors.join(often, "h"), "repeated-anchors")


def _contents(docs: DataFrame, chosen: DataFrame, units: Units) -> DataFrame:
    """h, context, copies, before, after: the stored units of each chosen context, read from one of its documents."""
    lists = chosen.groupBy("doc_id", "mark").agg(
        F.collect_list(F.struct("h", "context", "copies", "crowd", "at", "left", "right")).alias("wanted")
    )
    texts = docs.join(lists, docs["doc_id"].eqNullSafe(lists["doc_id"]) & (docs["mark"] == lists["mark"]))
    texts = texts.select(docs["text"], "wanted")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            _, stored, bounds = units(batch.column("text"))
            wanted = batch.column("wanted")
            text = np.repeat(np.arange(batch.num_rows), wanted.value_lengths().to_numpy())
            flat = wanted.flatten()
            at = flat.field("at").to_numpy() + bounds[text]
            low, high = at - flat.field("left").to_numpy(), at + flat.field("right").to_numpy()
            before = [stored[a:b].tobytes() for a, b in zip(low.tolist(), at.tolist(), strict=True)]
            after = [stored[a:b].tobytes() for a, b in zip(at.tolist(), high.tolist(), strict=True)]
            names = ["h", "context", "copies", "crowd"]
            yield pa.RecordBatch.from_arrays(
                [*(flat.field(n) for n in names), pa.array(before, pa.binary()), pa.array(after, pa.binary())],
                names=[*names, "before", "after"],
            )

    return texts.mapInArrow(run, "h long, context long, copies long, crowd long, before binary, after binary")


def _solved(contexts: DataFrame, solver: Solver, length: int) -> DataFrame:
    """h, context, low, high for the contexts of anchors that have a bounded number of them."""

    def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
        held: list[tuple] = []
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("h", "context", "copies", "before", "after")), strict=True):
                if held and held[0][0] != row[0]:
                    yield held
                    held = []
                if not held or held[-1][1] != row[1]:  # sorted: a context read from two equal rows stands twice
                    held.append(row)
        if held:
            yield held

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for group in groups(batches):
            found = solver([(before, after, copies) for _, _, copies, before, after in group], length)
            for row, spans in zip(group, found, strict=True):
                if spans:
                    out.append((row[0], row[1], min(low for low, _ in spans), max(high for _, high in spans)))
            if len(out) > 5000:
                yield _reach_batch(out)
                out = []
        if out:
            yield _reach_batch(out)

    rows = contexts.repartition("h").sortWithinPartitions("h", "context")
    return rows.mapInArrow(run, "h long, context long, low int, high int")


def _reach_batch(rows: list[tuple]) -> pa.RecordBatch:
    h, context, low, high = zip(*rows, strict=True)
    return pa.record_batch(
        {"h": pa.array(h, pa.int64()), "context": pa.array(context, pa.int64()), "low": pa.array(low, pa.int32()), "high": pa.array(high, pa.int32())}
    )


def _by_window(contexts: DataFrame, length: int, item: str) -> DataFrame:
    """h, context, low, high for anchors with very many contexts: their windows are counted one by one, by hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("h", "context", "before", "after"))
            for h, context, before, after in zip(*columns, strict=True):
                left = len(before) // np.dtype(item).itemsize
                units = np.frombuffer(before + after, item).astype(np.uint64)
                last = min(left, len(units) - length)
                if last < 0:
                    continue
                low = np.arange(last + 1)
                window = span_hash(prefix_hash(mix(units)), low, low + length)
                # The distance to the anchor is part of a window's name: one stretch of text is not taken for two.
                name = mix(window + (left - low).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(h & (2**64 - 1)))
                n = len(low)
                yield pa.record_batch(
                    {
                        "window": _signed(name), "h": pa.array(np.full(n, h)), "context": pa.array(np.full(n, context)),
                        "low": pa.array((low - left).astype(np.int32)),
                    }
                )

    rows = contexts.dropDuplicates(["h", "context"]).mapInArrow(run, "window long, h long, context long, low int")
    rows = written(rows, "windows")
    often = rows.groupBy("window").agg(F.count("*").alias("n")).where("n > 1").select("window")
    reach = (F.min("low").alias("low"), (F.max("low") + length).cast("int").alias("high"))
    return rows.join(often, "window").groupBy("h", "context").agg(*reach)


def repeated_spans(docs: DataFrame, units: Units, solver: Solver, length: int, width: int, item: str, crowd: int = CROWD) -> DataFrame:
    """doc_id, mark, spans (array of [low, high) in units, overlapping): where docs (doc_id, text, mark) repeat.

    A context reaches so little beyond its anchor that every span of `length` units in it holds the anchor. So the spans
    of a context overlap, and what they cover together is one stretch, from the lowest start to the highest end.
    """
    ship_package()
    anchors = _repeated(docs, units, length, width)
    first = F.min(F.struct("doc_id", "mark", "at", "left", "right")).alias("first")
    contexts = anchors.groupBy("h", "context").agg(F.count("*").alias("copies"), first)
    contexts = written(contexts.select("h", "context", "copies", "first.*"), "contexts")
    kinds = contexts.groupBy("h").agg(F.count("*").alias("crowd"))
    # A context with copies repeats from end to end; the others are compared with what shares their anchor.
    full = contexts.where("copies > 1").where(F.col("left") + F.col("right") >= length)
    whole = full.select("h", "context", (-F.col("left")).alias("low"), F.col("right").alias("high"))
    compared = contexts.join(kinds.where("crowd > 1"), "h")
    read = written(_contents(docs, compared, units), "context-units")
    solved = _solved(read.where(F.col("crowd") <= crowd), solver, length)
    dealt = _by_window(read.where(F.col("crowd") > crowd), length, item)
    found = written(whole.union(solved).union(dealt), "spans")
    placed = anchors.select("h", "context", "doc_id", "mark", "at").join(found, ["h", "context"])
    # Neighbouring contexts mostly say the same: what a document has of one span is one.
    span = F.struct((F.col("at") + F.col("low")).alias("low"), (F.col("at") + F.col("high")).alias("high"))
    return placed.groupBy("doc_id", "mark").agg(F.collect_set(span).alias("spans"))


def marked(docs: DataFrame) -> DataFrame:
    """docs with a hash of the text: rows of equal doc_id and mark are equal, and have equal results."""
    return docs.withColumn("text", F.coalesce("text", F.lit(""))).withColumn("mark", F.xxhash64("text"))


def covered(spans: list[dict] | None, size: int) -> np.ndarray:
    """Which of `size` units some span holds."""
    depth = np.zeros(size + 1, np.int64)
    if spans is not None and len(spans):
        np.add.at(depth, [s["low"] for s in spans], 1)
        np.add.at(depth, [s["high"] for s in spans], -1)
    return np.cumsum(depth)[:size] > 0
