"""Dedup, skip, change detection and the field-wise upsert, all keyed.

Every input is read once: the first of a key and the upsert are one grouped aggregate, the lookup in a store one join.
What a store need not be asked for is left out before, by `sources.cells.read_for_keys`.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import is_blank
from tidemark.schemas import FILE_FIELDS

KEY = ("identifier",)


def any_blank(df: DataFrame, key: Sequence[str]) -> Column:
    strings = [name for name, kind in df.dtypes if name in key and kind == "string"]
    tests = [is_blank(c) if c in strings else F.col(c).isNull() for c in key]
    return reduce(lambda left, right: left | right, tests)


def _salted(records: DataFrame, key: Sequence[str]) -> tuple[DataFrame, int]:
    """Records with `_salt`: 0 for a keyed one, 1..n for a blank one; and n.

    Records without a key may be a third of all; joined on the key alone they would share one task.
    """
    salts = int(records.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hashable = [n for n, kind in records.dtypes if kind != "binary" and not kind.startswith("map")]
    spread = F.pmod(F.xxhash64(*hashable), F.lit(salts)).cast("int") + 1
    return records.withColumn("_salt", F.when(any_blank(records, key), spread).otherwise(0)), salts


def dedup_first(records: DataFrame, order: Sequence[str], key: Sequence[str] = KEY) -> DataFrame:
    """Keep the first record of each key in `order`; blank keys name nothing and all stay.

    One grouped aggregate: each task cuts a key to one row before the shuffle, so a key holding a third of the rows
    reaches its reducer as a handful. Blank records have a group each, by their place in their task.
    """
    own = F.when(any_blank(records, key), F.monotonically_increasing_id())
    first = F.min_by(F.struct(*records.columns), F.struct(*order))
    return (
        records.withColumn("_own", own)
        .groupBy(*key, "_own")
        .agg(first.alias("_first"))
        .select("_first.*")
    )


def mark_stored(records: DataFrame, stored: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """Add `already_stored`: the key is in `stored` and not blank. Records without a key meet nothing."""
    known = stored.where(~any_blank(stored, key)).select(*key).distinct()
    known = known.withColumns({"_salt": F.lit(0), "_stored": F.lit(True)})
    salted, _ = _salted(records, key)
    return salted.join(known, [*key, "_salt"], "left").select(
        *records.columns, F.coalesce("_stored", F.lit(False)).alias("already_stored")
    )


def split_stored(
    records: DataFrame, stored: DataFrame, key: Sequence[str] = KEY
) -> tuple[DataFrame, DataFrame]:
    """(new, skipped): records to fetch, and those an earlier run has stored."""
    marked = mark_stored(records, stored, key)
    return (
        marked.where(~F.col("already_stored")).drop("already_stored"),
        marked.where("already_stored").drop("already_stored"),
    )


def _same(left: Sequence[str], right: Sequence[str]) -> Column:
    """NULL-safe equality of two lists of columns."""
    pairs = [F.col(a).eqNullSafe(F.col(b)) for a, b in zip(left, right)]
    return reduce(lambda x, y: x & y, pairs)


def with_stored(
    new: DataFrame, stored: DataFrame, key: Sequence[str] = KEY, carry: Sequence[str] = ()
) -> DataFrame:
    """Add what is stored under each record's key: `was_stored`, `stored_<name>`.

    A narrow lookup, meant to run before any bytes are attached; NULL is a key too. `stored` holds one row per key;
    its few blank keys are repeated per salt to meet their many records.
    """
    columns = list(dict.fromkeys(["file_hash", "file_path", *carry]))
    keys = [f"_key_{c}" for c in key]
    salted, salts = _salted(new, key)
    every_salt = F.when(any_blank(stored, key), F.sequence(F.lit(1), F.lit(salts)))
    old = stored.select(
        *(F.col(c).alias(k) for c, k in zip(key, keys)),
        *(F.col(c).alias(f"stored_{c}") for c in columns),
        F.explode(F.coalesce(every_salt, F.array(F.lit(0)))).alias("_stored_salt"),
        F.lit(True).alias("_found"),
    )
    on = _same([*key, "_salt"], [*keys, "_stored_salt"])
    return (
        salted.join(old, on, "left")
        .withColumn("was_stored", F.coalesce("_found", F.lit(False)))
        .drop("_salt", "_stored_salt", "_found", *keys)
    )


def change() -> Column:
    """'new', 'changed' or 'unchanged' of a record that knows its stored hash."""
    same_hash = F.col("file_hash").eqNullSafe(F.col("stored_file_hash"))
    return (
        F.when(~F.col("was_stored"), "new").when(same_hash, "unchanged").otherwise("changed")
    )


def write_file() -> Column:
    """Whether the bytes are to be written: the hash *or* the path differs.

    With the hash alone, metadata could point at a path that was never written.
    """
    same_hash = F.col("file_hash").eqNullSafe(F.col("stored_file_hash"))
    same_path = F.col("file_path").eqNullSafe(F.col("stored_file_path"))
    return F.col("file_hash").isNotNull() & (~F.col("was_stored") | ~same_hash | ~same_path)


def classify_changes(new: DataFrame, stored: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """Add `change` and `write_file` to hashed records, against the stored ones."""
    return with_stored(new, stored, key).select(
        *new.columns, change().alias("change"), write_file().alias("write_file")
    )


def merge_set(
    stored: DataFrame,
    batch: DataFrame,
    order: Sequence[str],
    key: Sequence[str] = KEY,
    sticky: Sequence[str] = FILE_FIELDS,
    has_content: str = "has_content",
) -> DataFrame:
    """Field-wise upsert of a batch, in `order`, into one row per key (NULL is a key too).

    Present fields overwrite, also with NULL; the `sticky` ones are present only where `has_content`, and otherwise
    keep their last value.

    Store and batch are folded together in one grouped aggregate, a stored row before every row of the batch. Tasks
    combine before the shuffle, so a hot key (all NULL ones share one) costs each of them a single row.
    """
    columns = stored.columns
    plain = [c for c in columns if c not in (*key, *sticky)]
    kinds = dict(batch.dtypes)
    nothing = [F.lit(None).cast(kinds[c]).alias(c) for c in order]
    content = F.coalesce(F.col(has_content), F.lit(False))

    def as_rows(rows: DataFrame, when: Column, present: Column) -> DataFrame:
        return rows.select(
            *key, F.struct(*plain).alias("_plain"), F.struct(*sticky).alias("_sticky"), when.alias("_when"), present.alias("_present")
        )

    # A struct of NULL places comes first: nothing of the batch can come before what is stored.
    old = as_rows(stored, F.struct(F.lit(0).alias("_batch"), *nothing), F.lit(True))
    new = as_rows(batch, F.struct(F.lit(1).alias("_batch"), *order), content)
    folded = old.unionByName(new).groupBy(*key).agg(
        F.max_by("_plain", "_when").alias("_plain"),
        F.max_by("_sticky", F.when(F.col("_present"), F.col("_when"))).alias("_sticky"),
    )
    return folded.select(
        *(F.col(c) if c in key else F.col(f"_plain.{c}" if c in plain else f"_sticky.{c}").alias(c) for c in columns)
    )
