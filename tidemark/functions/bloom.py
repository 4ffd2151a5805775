"""Bloom filters as plain columns: bitmaps of 32,768 bits in a map, built by aggregates and asked by expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Bits of one bitmap, as Spark's bitmap functions lay it out.
CHUNK = 32_768
# Bits per key, and how many of them a key sets: one key in eight thousand is taken for another.
BITS_PER_KEY, PROBES = 24, 6


def hashes(key: Sequence[str]) -> Column:
    """Two 64-bit hashes of a key, of which all its positions are made. NULL is a key too."""
    return F.struct(F.xxhash64(*key).alias("a"), F.xxhash64(*key, F.lit(1)).alias("b"))


def positions(hashed: Column, chunks: Column) -> Column:
    """The bits that a key sets among those of `chunks` bitmaps."""
    span = chunks.cast("bigint") * CHUNK
    start, step = F.pmod(hashed["a"], span), F.pmod(hashed["b"], span)
    return F.transform(F.sequence(F.lit(0), F.lit(PROBES - 1)), lambda i: F.pmod(start + step * i, span))


def chunks_for(keys: Column) -> Column:
    """Bitmaps for so many keys."""
    return F.greatest(F.lit(1), F.ceil(keys * BITS_PER_KEY / CHUNK)).cast("bigint")


def build(rows: DataFrame, by: Sequence[str], key: Sequence[str]) -> DataFrame:
    """Per group: `by`, records, chunks, and `bits`, a map of bitmaps.

    Two narrow passes over `rows`: the number of keys sizes the filter that the second one fills.
    """
    sized = rows.groupBy(*by).agg(F.count("*").alias("records")).withColumn("chunks", chunks_for(F.col("records")))
    named = [F.col(c).alias(f"_by_{c}") for c in by]
    same = [F.col(c).eqNullSafe(F.col(f"_by_{c}")) for c in by]
    spots = (
        rows.select(*named, hashes(key).alias("_hash"))
        .join(sized, same)
        .select(*by, "records", "chunks", F.explode(positions(F.col("_hash"), F.col("chunks"))).alias("_at"))
    )
    chunk = F.floor(F.col("_at") / CHUNK)
    maps = spots.groupBy(*by, "records", "chunks", chunk.alias("_chunk")).agg(
        F.bitmap_construct_agg(F.col("_at") % CHUNK).alias("_map")
    )
    return maps.groupBy(*by, "records", "chunks").agg(
        F.map_from_entries(F.collect_list(F.struct("_chunk", "_map"))).alias("bits")
    )


def _is_set(bits: Column, position: Column) -> Column:
    bitmap = F.try_element_at(bits, F.floor(position / CHUNK))
    within = position % CHUNK
    byte = F.substring(bitmap, (F.floor(within / 8) + 1).cast("int"), F.lit(1))
    value = F.conv(F.hex(byte), 16, 10).cast("bigint")
    return F.coalesce(F.floor(value / F.pow(F.lit(2), within % 8)) % 2 == 1, F.lit(False))


def may_hold(bits: Column, chunks: Column, asked: Column) -> Column:
    """Whether a filter may hold one of the asked keys (an array of `hashes`); never false where it does."""
    return F.exists(asked, lambda h: F.forall(positions(h, chunks), lambda p: _is_set(bits, p)))
