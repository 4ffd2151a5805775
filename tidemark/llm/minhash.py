"""MinHash near-duplicates with circulant signatures, banding and exact verification.

Two permutations make the whole signature: the first scatters the shingles, the second is applied to the result shifted
round by k steps for coordinate k. Documents with the same shingle set are one class; classes that agree in a band share a
bucket. First every class is compared with the smallest of its buckets; then, wherever a bucket still holds several
components, with those of other components there that have a common shingle far enough in front among their rarest and whose
parity bitmaps do not rule a link out. So no link between candidates that matters is left out, a bucket of many copies costs
one comparison each, and copies of one text that are each too far from the others are not compared in pairs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.shipping import ship_package
from tidemark.llm.components import components
from tidemark.llm.staging import written
from tidemark.llm.words import Words, buffer, mix, slices, split_words

#: Bands and rows of the signature: a pair at similarity 0.85 is missed with a chance of two in a million, and documents that share
#: a third of their shingles, as by one common passage, meet in a band with a chance of one in six thousand.
BANDS, ROWS = 42, 8
#: Words of a shingle, and the least similarity of linked documents.
SHINGLE, SIMILARITY = 5, (85, 100)

#: Bytes of texts or shingle sets that a task is handed at once; a larger row is handed alone.
BATCH_BYTES = 4 << 20

#: 64-bit words of a set's parity bitmap.
PARITY = 16

_STEP = np.uint32(0x9E3779B1)


def shingles(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text of every shingle; a text of fewer words is one shingle."""
    hashes, count = words.hashes(True), len(words.text)
    bounds = words.bounds()
    n = np.diff(bounds)
    width = np.minimum(n, size)
    start = np.arange(count)
    first = start[(start - bounds[words.text]) <= (n - width)[words.text]]
    out = np.zeros(len(first), np.uint64)
    for k in range(size):
        inside = k < width[words.text[first]]
        at = np.minimum(first + k, count - 1)
        out = np.where(inside, mix(out * np.uint64(0xD6E8FEB86659FD93) + hashes[at] + np.uint64(k + 1)), out)
    return out, words.text[first]


def signature(x: np.ndarray, starts: np.ndarray, coordinates: int) -> np.ndarray:
    """Circulant MinHash of the runs of x that begin at starts: one row per run."""
    scattered = (mix(x) >> np.uint64(32)).astype(np.uint32)
    out = np.empty((len(starts), coordinates), np.uint32)
    for k in range(coordinates):
        y = (scattered + np.uint32(k * int(_STEP) & 0xFFFFFFFF)) * np.uint32(0x85EBCA6B)
        y ^= y >> np.uint32(15)
        y *= np.uint32(0xC2B2AE35)
        y ^= y >> np.uint32(13)
        out[:, k] = np.minimum.reduceat(y, starts)
    return out


def _sets(batch: pa.RecordBatch, size: int) -> Iterator[tuple[int, np.ndarray]]:
    """Row and sorted distinct shingles of each text that has any."""
    x, text = shingles(split_words(batch.column("text")), size)
    edges = np.flatnonzero(np.diff(text)) + 1
    for part, row in zip(np.split(x, edges), text[np.append(0, edges)] if len(text) else [], strict=False):
        yield int(row), np.unique(part)


def parity(x: np.ndarray) -> list[int]:
    """Bitmap of the parities of how many shingles fall on each bit: two sets differ in at least as many shingles as bitmaps in bits."""
    odd = np.bincount((x % np.uint64(64 * PARITY)).astype(np.int64), minlength=64 * PARITY) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64).tolist()


def may_be_alike(x: str, y: str, nx: Column, ny: Column, similarity: tuple[int, int]) -> Column:
    """False only where the bitmaps x and y of sets of nx and ny shingles show more differences than similar sets have."""
    least, whole = similarity
    differences = sum((F.bit_count(F.col(x)[k].bitwiseXOR(F.col(y)[k])) for k in range(PARITY)), F.lit(0))
    return (least + whole) * differences <= (whole - least) * (nx + ny)


def mark():
    """Hash of a row's text, which tells apart rows of one doc_id."""
    return F.xxhash64(F.coalesce("text", F.lit("")))


def signed(docs: DataFrame, size: int, bands: int, rows: int) -> DataFrame:
    """doc_id, mark, n_shingles, node (digest of the shingle set; null without one), bands (array<long>); written."""
    ship_package()
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        salt = mix(np.arange(1, bands + 1, dtype=np.uint64))
        for batch in slices(batches, "text"):
            n, node = np.zeros(batch.num_rows, np.int64), [None] * batch.num_rows
            buckets: list = [None] * batch.num_rows
            found = list(_sets(batch, size))
            if found:
                length = np.array([len(x) for _, x in found])
                signs = signature(np.concatenate([x for _, x in found]), np.cumsum(length) - length, bands * rows)
                keys = np.zeros((len(found), bands), np.uint64) + salt
                for r in range(rows):
                    keys = mix(keys * np.uint64(0xD6E8FEB86659FD93) + signs[:, r::rows])
                for (row, x), own in zip(found, keys.view(np.int64).tolist(), strict=True):
                    n[row], node[row], buckets[row] = len(x), hashlib.md5(x.tobytes()).digest(), own
            yield pa.record_batch(
                {
                    "doc_id": batch.column("doc_id"), "mark": batch.column("mark"), "n_shingles": pa.array(n),
                    "node": pa.array(node, pa.binary()), "bands": pa.array(buckets, pa.list_(pa.int64())),
                }
            )

    schema = f"doc_id {kind}, mark long, n_shingles long, node binary, bands array<long>"
    return written(docs.select("doc_id", "text", mark().alias("mark")).mapInArrow(run, schema), "signatures", BATCH_BYTES)


def similar(pairs: DataFrame, sets: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """The pairs (a, b) whose shingle sets are similar enough, by exact comparison."""
    least, whole = similarity

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "x"):
            keep = []
            for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist(), strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(whole * common >= least * (len(x) + len(y) - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    both = pairs.join(sets.select(F.col("node").alias("a"), F.col("set").alias("x")), "a").join(
        sets.select(F.col("node").alias("b"), F.col("set").alias("y")), "b"
    )
    return both.select("a", "b", "x", "y").mapInArrow(run, "a binary, b binary")


def alike_in_size(pairs: DataFrame, sets: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """The pairs (a, b) whose sets are not too different in size and bitmap to be similar; that needs no set."""
    least, whole = similarity
    sized = sets.select("node", "size", "parity")
    both = pairs.join(sized.toDF("a", "na", "pa"), "a").join(sized.toDF("b", "nb", "pb"), "b")
    near = may_be_alike("pa", "pb", F.col("na"), F.col("nb"), similarity)
    return both.where((whole * F.least("na", "nb") >= least * F.greatest("na", "nb")) & near).select("a", "b")


def meetings(mixed: DataFrame, sets: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """The pairs (a, b) of mixed (node, component, buckets) that share a bucket, are of different components, and can be similar.

    The shingles of a set are put in order, those that fewest sets have first. Of two sets with `need` common shingles,
    the first common one has at least need - 1 others behind it in both. So only the foremost shingles of a set are
    joined, which copies with edits of their own mostly have alone, and of two sets that meet there the bitmaps are compared
    before a pair is made. No pair that is similar enough is left out by either.
    """
    least, whole = similarity
    ship_package()
    own = mixed.select("node").join(sets, "node")

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "set"):
            data, offsets = buffer(batch.column("set"))
            node = np.repeat(np.arange(batch.num_rows), np.diff(offsets) // 8)
            yield pa.record_batch({"node": batch.column("node").take(pa.array(node)), "shingle": pa.array(np.frombuffer(data.tobytes(), np.int64))})

    each = written(own.select("node", "set").mapInArrow(listed, "node binary, shingle long"), "mixed-shingles", BATCH_BYTES)
    often = each.groupBy("shingle").agg(F.count("*").alias("n")).where("n > 1")
    # `left`: shingles from here to the end of the order. Those that one set alone has come first, meet nothing, and go.
    behind = F.row_number().over(Window.partitionBy("node").orderBy(F.desc("n"), F.desc("shingle")))
    heads = (
        each.join(often, "shingle").withColumn("left", behind)
        .join(sets.select("node", "size", "parity"), "node")
        .where(whole * F.col("left") >= least * F.col("size"))
        .join(mixed, "node")
    )
    heads = written(heads.select("shingle", "node", "component", "buckets", "size", "parity", "left"), "foremost-shingles")
    x, y = heads.alias("x"), heads.alias("y")
    common = F.least("x.left", "y.left")
    can = (
        (F.col("x.shingle") == F.col("y.shingle")) & (F.col("x.node") < F.col("y.node")) & (F.col("x.component") != F.col("y.component"))
        & ((least + whole) * common >= least * (F.col("x.size") + F.col("y.size")))
        & may_be_alike("x.parity", "y.parity", F.col("x.size"), F.col("y.size"), similarity)
        & F.arrays_overlap("x.buckets", "y.buckets")
    )
    return x.join(y, can).select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct()


def near_duplicates(
    docs: DataFrame,
    similarity: tuple[int, int] = SIMILARITY,
    size: int = SHINGLE,
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """One row per row of docs: doc_id, n_shingles, component_id (smallest doc_id reachable over links), kept.

    Links hold where similarity[1] * |intersection| >= similarity[0] * |union|. A null text counts as empty; without words a
    document has no shingles and is linked with nothing. Rows of one doc_id and text are copies of each other; a row
    without doc_id is compared with nothing, has a null component_id and is kept. Other columns are ignored.
    """
    return marked(docs, similarity, size, bands, rows).drop("mark", "component")


def marked(
    docs: DataFrame,
    similarity: tuple[int, int] = SIMILARITY,
    size: int = SHINGLE,
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """What near_duplicates returns, and each row's mark and component (null without words or doc_id)."""
    ship_package()
    marks = signed(docs, size, bands, rows)
    named = marks.where("doc_id IS NOT NULL AND node IS NOT NULL")
    classes = named.groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.first("bands").alias("bands"))
    spots = classes.select("node", F.explode("bands").alias("bucket"))
    centers = spots.groupBy("bucket").agg(F.min("node").alias("center"), F.count("*").alias("n")).where("n > 1")
    crowded = written(spots.join(centers.select("bucket", "center"), "bucket"), "buckets")

    # Shingle sets of the classes that meet another one, each from one of its documents.
    meeting = crowded.select("node").distinct()
    chosen = named.join(meeting, "node").groupBy("node").agg(F.min("doc_id").alias("doc_id"))

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = [(hashlib.md5(x.tobytes()).digest(), len(x), parity(x), x.tobytes()) for _, x in _sets(batch, size)]
            if found:
                kinds = (pa.binary(), pa.int64(), pa.list_(pa.int64()), pa.binary())
                columns = [pa.array(c, kind) for c, kind in zip(zip(*found, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=["node", "size", "parity", "set"])

    texts = docs.select("doc_id", "text").join(chosen.select("doc_id").distinct(), "doc_id").select("text")
    sets = texts.mapInArrow(gather, "node binary, size long, parity array<long>, set binary")
    sets = written(sets.dropDuplicates(["node"]), "shingle-sets", BATCH_BYTES)

    ordered = (F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b"))
    star = crowded.where("node != center").select("node", F.col("center").alias("other")).select(*ordered).distinct()
    star = written(star, "star-pairs")
    links = written(similar(alike_in_size(star, sets, similarity), sets, similarity), "links", BATCH_BYTES)
    groups = components(links)
    # Where a bucket still holds several components, its classes are compared with those of other components.
    labelled = crowded.join(groups, "node", "left").select(
        "bucket", "node", F.coalesce("component", "node").alias("component")
    )
    several = labelled.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    mixed = labelled.join(several.where("low != high").select("bucket"), "bucket")
    mixed = mixed.groupBy("node", "component").agg(F.collect_list("bucket").alias("buckets"))
    rest = written(meetings(written(mixed, "mixed-classes"), sets, similarity), "rest-pairs")
    more = similar(rest.join(star, ["a", "b"], "left_anti"), sets, similarity)
    links = written(links.union(more), "links", BATCH_BYTES)
    groups = components(links)
    members = named.select("doc_id", "node").join(groups, "node", "left").select(
        "doc_id", "node", F.coalesce("component", "node").alias("component")
    )
    smallest = members.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    # By class, not by document: a class of very many copies is one row here.
    by_node = members.select("node", "component").distinct().join(smallest, "component").select("node", "component", "component_id")
    out = marks.select("doc_id", "mark", "n_shingles", "node").join(by_node, "node", "left")
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return out.select(
        "doc_id", "n_shingles", own.alias("component_id"), F.coalesce(own == F.col("doc_id"), F.lit(True)).alias("kept"),
        "mark", F.when(F.col("doc_id").isNotNull(), F.col("component")).alias("component"),
    )
