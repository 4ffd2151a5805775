"""Quality rules: surface counts of a text, and a hashed n-gram log-likelihood ratio with a fixed threshold.

The ratio compares two multinomials over hashed words and word pairs: one of a trusted target (documents labelled good),
one of the whole corpus. A document's score is the mean log ratio of its words and pairs, so that length does not
count. Everything is column expressions; no row leaves its partition but for the bucket counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Buckets of the hashed words and pairs: bounds the table of ratios, whatever the corpus.
BUCKETS = 1 << 14
#: Trusted documents that the target is counted over at most, chosen by hash of their id.
TRUSTED = 20_000
#: Least mean log ratio of a kept document.
THRESHOLD = -0.12

RESULT = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "score", "kept"]

_SPACE = r"[\x20\x09-\x0D]+"


def _count(array: Column) -> Column:
    return F.size(array).cast("long")


def _carried(docs: DataFrame) -> list[Column]:
    """The columns of docs, named so that they keep out of the way of names used here."""
    return [F.col(f"`{c}`").alias(f"carried_{i}") for i, c in enumerate(docs.columns)]


def with_words(docs: DataFrame) -> DataFrame:
    """The columns of docs under other names, doc_id, text, and the hashes of words (h1), pairs (h2) and 5-word windows (h5) of each text."""
    words = F.filter(F.split(F.coalesce("text", F.lit("")), _SPACE), lambda w: w != "")
    at = lambda i: F.get("h1", i)
    return (
        docs.select(*_carried(docs), "doc_id", F.coalesce("text", F.lit("")).alias("text"), words.alias("words"))
        .withColumn("h1", F.transform("words", lambda w: F.xxhash64(w)))
        .withColumn("n_words", F.size("h1"))
        .withColumn(
            "h2",
            F.transform(F.slice("h1", 1, F.greatest(F.col("n_words") - 1, F.lit(0))), lambda x, i: F.xxhash64(x, at(i + 1))),
        )
        .withColumn(
            "h5",
            F.transform(
                F.slice("h1", 1, F.greatest(F.col("n_words") - 4, F.lit(0))),
                lambda x, i: F.xxhash64(x, at(i + 1), at(i + 2), at(i + 3), at(i + 4)),
            ),
        )
    )


def surface(worded: DataFrame) -> DataFrame:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and base_failed for what with_words returns.

    Windows are compared by 64-bit hash within one text. Only a text with an equal pair of windows has them sorted; the
    words in such windows are then the sum of their distances, five at most each.
    """
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    hit = lambda e, j: (e.x == F.get("ordered", j - 1).x) | (e.x == F.get("ordered", j + 1).x)
    pairs = F.sort_array(F.transform("h5", lambda x, i: F.struct(x.alias("x"), i.alias("i"))))
    steps = F.transform("spots", lambda p, j: F.coalesce(F.least(F.get("spots", j + 1) - p, F.lit(5)), F.lit(5)))
    return (
        worded.withColumn("lines", lines)
        .withColumn("ordered", F.when(F.size("h5") > F.size(F.array_distinct("h5")), pairs))
        .withColumn(
            "spots",
            F.sort_array(
                F.filter(
                    F.transform("ordered", lambda e, j: F.when(F.coalesce(hit(e, j), F.lit(False)), e.i)),
                    lambda p: p.isNotNull(),
                )
            ),
        )
        .withColumns(
            {
                "n_words": F.col("n_words").cast("long"),
                "word_chars": F.length(F.array_join("words", "")).cast("long"),
                "n_symbols": (
                    F.octet_length("text") - F.octet_length(F.regexp_replace("text", r"[#*$%&|<>]+", ""))
                ).cast("long"),
                "n_dup_lines": _count(F.col("lines")) - _count(F.array_distinct("lines")),
                "n_repeat_words": F.coalesce(
                    F.aggregate(steps, F.lit(0).cast("long"), lambda a, s: a + s), F.lit(0).cast("long")
                ),
            }
        )
        .withColumn("base_failed", (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")))
    )


def trusted_ids(labels: DataFrame, bound: int = TRUSTED) -> DataFrame:
    """Ids of documents labelled good and not toxic: the `bound` first by hash."""
    good = labels.groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))
    good = good.where((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0) & F.col("doc_id").isNotNull())
    return good.select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)


def log_ratios(worded: DataFrame, trusted: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """One row: the array of log ratios by bucket, counts plus one in target and corpus alike."""
    spark = worded.sparkSession
    flagged = worded.join(F.broadcast(trusted.withColumn("trusted", F.lit(1))), "doc_id", "left")
    counts = (
        flagged.select(F.explode(F.concat("h1", "h2")).alias("h"), F.coalesce("trusted", F.lit(0)).alias("trusted"))
        .groupBy(F.pmod("h", F.lit(buckets)).alias("bucket"))
        .agg(F.count("*").alias("raw"), F.sum("trusted").alias("target"))
    )
    every = spark.range(buckets).select(F.col("id").alias("bucket")).join(counts, "bucket", "left").na.fill(0)
    table = every.agg(
        F.sort_array(F.collect_list(F.struct("bucket", "raw", "target"))).alias("cells"),
        F.sum("raw").alias("raw"),
        F.sum("target").alias("target"),
    )
    # With no trusted document the two multinomials are taken as equal.
    ratio = lambda c: F.when(
        F.col("target") > 0,
        F.log((c.target + 1) / (F.col("target") + buckets)) - F.log((c.raw + 1) / (F.col("raw") + buckets)),
    ).otherwise(F.lit(0.0))
    return table.select(F.transform("cells", ratio).alias("ratios"))


def judge(
    docs: DataFrame,
    labels: DataFrame,
    threshold: float = THRESHOLD,
    buckets: int = BUCKETS,
    trusted: int = TRUSTED,
) -> DataFrame:
    """One row per document: doc_id, the counts of `surface`, score, kept.

    A document is kept if the base rules pass and its mean log ratio is at least `threshold`. A null text counts as
    empty; an empty text has score 0.0 and fails the base rules. Every row is judged, repeated and null ids included;
    columns other than doc_id and text are ignored.
    """
    return _judged(docs.select("doc_id", "text"), labels, threshold, buckets, trusted).select(*RESULT)


def accepted(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs, all columns, that `judge` keeps."""
    judged = _judged(docs, labels, threshold, BUCKETS, TRUSTED)
    # The id keeps the filter above the projections: pushed down, it would work out the arrays anew for every element.
    return judged.withColumn("fence", F.monotonically_increasing_id()).where("kept AND fence >= 0").select(
        *(F.col(f"carried_{i}").alias(c) for i, c in enumerate(docs.columns))
    )


def _judged(docs: DataFrame, labels: DataFrame, threshold: float, buckets: int, trusted: int) -> DataFrame:
    """What judge returns, and the columns of docs as with_words names them."""
    worded = with_words(docs)
    # A table of `buckets` numbers, whatever the corpus: the driver reads it and puts it into the plan as a literal.
    row = log_ratios(worded, trusted_ids(labels, trusted), buckets).first()
    ratios = F.split(F.lit(",".join(map(repr, row["ratios"]))), ",").cast("array<double>")
    total = F.aggregate(
        F.concat("h1", "h2"), F.lit(0.0), lambda a, h: a + F.get(ratios, F.pmod(h, F.lit(buckets)).cast("int"))
    )
    n = F.size("h1") + F.size("h2")
    scored = surface(worded).withColumn("score", F.when(n > 0, total / n).otherwise(F.lit(0.0)))
    return scored.select(
        *(f"carried_{i}" for i in range(len(docs.columns))), *RESULT[:-1],
        (~F.col("base_failed") & (F.col("score") >= threshold)).alias("kept"),
    )
