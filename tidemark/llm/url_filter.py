"""URL filter: rules of hosts and path beginnings, and for all other URLs a logistic regression on hashed character n-grams.

Everything is column expressions. The regression is trained by full gradient steps over a small labelled table, inside one
row; only its weights, as many as there are buckets, come to the driver and go back into the plan as a literal.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Buckets of the n-grams; one more weight is that of every URL.
BUCKETS = 8191
#: Factor of the hash: an n-gram is a number in this base, taken modulo the buckets.
BASE = 1009
#: Lengths of the n-grams.
GRAMS = (3, 4)
#: Full gradient steps, their length, and the pull to zero.
STEPS, RATE, PULL = 100, 4.0, 0.0005
#: Labelled URLs that a training takes at most; more are an error.
LABELLED = 1000
#: (rule, verdict): a host, a slash and the beginning of a path.
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))

#: The labelled URLs: invented hosts, the unwanted ones first.
UNWANTED = """
    http://casino-royal.example.org/en/12 https://www.bestcasino.example.com/fr/904.html http://casinos.example.net/es/7/
    https://m.lucky-casino.example.com/en/3150?page=2 http://win-big-casino.example.org/de/44#top https://jackpot-win.example.net/fr/81
    http://www.winner-slots.example.com/es/5.html https://slots-and-poker.example.org/en/6/ http://poker-bets.example.net/de/77
    https://freebets.example.com/es/108?utm_source=feed http://blog.sure-bets.example.org/fr/9021 https://free-spins.example.net/en/4
    http://www.free-betting.example.com/de/31.html https://betting-tips.example.org/es/650/ http://cheap-meds.example.com/en/93
    https://buy-pills.example.net/fr/2204 http://m.diet-pills.example.org/es/17.html https://pillshop.example.com/en/5608?ref=x
    http://cheap-viagra.example.org/en/8/ https://www.cheapest-pharma.example.net/de/13#top http://blog.pharma-pills.example.com/fr/62
    https://ads-server.example.com/en/41 http://track-ads.example.net/es/302.html https://adstracking.example.org/en/11?page=2
    http://click-track.example.com/fr/73/ https://www.tracker-ads.example.org/de/5120 http://popup-ads.example.net/en/86#top
    https://fast-loans.example.com/es/20 http://www.payday-loan.example.org/en/7741.html https://xxx-videos.example.net/fr/15
    http://hot-xxx.example.com/de/3090/ https://adult-videos.example.org/en/207 http://www.adult-dating.example.net/es/96.html
    https://adults-only.example.com/de/18/ http://www.adult-chat.example.org/fr/3308 https://adult-films.example.net/en/61?page=2
    http://spam-links.example.com/fr/24 https://link-farm.example.org/en/905/ http://www.spamfarms.example.net/de/47.html
    https://content-farm.example.com/es/1290#top http://spammer.example.org/fr/38 https://free-download-crack.example.org/en/28 http://blog.cheap-watches.example.com/es/440
"""
WANTED = """
    http://library.example.org/en/12 https://www.school.example.com/fr/904.html http://thestation.example.net/es/7/
    https://m.weather.example.com/en/3150?page=2 http://garden-club.example.org/de/44#top https://thermal.example.net/fr/81
    http://www.nations.example.com/es/5.html https://theriver.example.org/en/6/ http://mathematics.example.net/de/77
    https://stadtrat.example.com/es/108?utm_source=feed http://blog.another.example.org/fr/9021 https://thinking.example.net/en/4
    http://www.northern.example.com/de/31.html https://theatre.example.org/es/650/ http://reading.example.com/en/93
    https://whether.example.net/fr/2204 http://m.tables.example.org/es/17.html https://thousand.example.com/en/5608?ref=x
    http://recipes.example.org/en/8/ https://www.health.example.net/de/13#top http://blog.thesis.example.com/fr/62
    https://motion.example.com/en/41 http://heritage.example.net/es/302.html https://possible.example.org/en/11?page=2
    http://history.example.com/fr/73/ https://www.thirteen.example.org/de/5120 http://ration.example.net/en/86#top
    https://strength.example.com/es/20 http://www.thrush.example.org/en/7741.html https://ethics.example.net/fr/15
    http://theory.example.com/de/3090/ https://thanks.example.org/en/28 http://blog.shelter.example.com/es/440
    https://tisch.example.net/de/610 http://www.monthly.example.org/en/52/ https://m.nation.example.com/fr/888.html
    http://thing.example.net/es/35 https://blog.athlete.example.org/en/470?utm_source=feed http://within.example.com/de/2#top
    https://mention.example.org/fr/19/ http://www.wherever.example.net/en/6604 https://m.anthem.example.com/es/71
    http://earthly.example.org/de/999.html https://bottle.example.net/en/321?page=2 http://terrain.example.com/fr/10/
    https://adsorption.example.org/en/57 http://www.freedom.example.com/es/83.html https://tractor.example.net/de/146
    http://window.example.org/en/2718 https://alphabet.example.com/fr/64#top http://winter.example.net/es/5091/
    https://cheddar.example.org/de/39 http://pillar.example.com/en/702.html https://better-bread.example.net/fr/8
"""


def labelled_urls(spark: SparkSession) -> DataFrame:
    """The given labelled table: url, unwanted (1 or 0)."""
    rows = [(u, 1) for u in UNWANTED.split()] + [(u, 0) for u in WANTED.split()]
    return spark.createDataFrame(rows, "url string, unwanted int")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for a null URL or one without ://."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    host, path = (F.coalesce(F.regexp_extract(url, pattern, i), F.lit("")) for i in (1, 2))
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null where none does. Of two equal ones the first counts."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, result in sorted(reversed(rules), key=lambda r: len(r[0])):
        domain, slash, rest = text.partition("/")
        if not domain or not slash or result not in ("allow", "block"):
            raise ValueError(f"a rule is a host, a slash and a path, and allows or blocks: {text!r}, {result!r}")
        fits = ((host == domain) | host.endswith(f".{domain}")) & path.startswith(slash + rest)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, result).otherwise(verdict)
    return rule, verdict


def with_grams(urls: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """The rows of urls (with host and path) and `grams`: the buckets of all n-grams of ^host$ and of the path."""
    letters = lambda s: F.transform(F.regexp_extract_all(s, F.lit("(?s)."), F.lit(0)), lambda c: F.ascii(c).cast("long"))
    coded = urls.withColumns(
        {"host_codes": letters(F.concat(F.lit("^"), "host", F.lit("$"))), "path_codes": letters(F.col("path"))}
    )

    def grams(codes: str, n: int, salt: int) -> Column:
        def bucket(first: Column, i: Column) -> Column:
            number = first
            for k in range(1, n):
                number = number * BASE + F.get(codes, i + k)
            return F.pmod(number * 16 + salt, F.lit(buckets)).cast("int")

        return F.transform(F.slice(codes, 1, F.greatest(F.size(codes) - (n - 1), F.lit(0))), bucket)

    parts = [grams(c, n, 8 * s + n) for s, c in enumerate(("host_codes", "path_codes")) for n in GRAMS]
    return coded.withColumn("grams", F.concat(*parts)).drop("host_codes", "path_codes")


def train(labelled: DataFrame, buckets: int = BUCKETS, steps: int = STEPS, bound: int = LABELLED) -> list[float]:
    """Weights by bucket, and last that of every URL.

    Rows without a URL or label are left out; repeated ones count as often as they stand there. Without any row all weights
    are 0. The table has at most `bound` rows, so that one task may hold it.
    """
    host, path = host_and_path(F.col("url"))
    rows = labelled.where("url IS NOT NULL AND unwanted IS NOT NULL").select("url", F.col("unwanted").cast("double").alias("y"))
    if rows.limit(bound + 1).count() > bound:
        raise ValueError(f"more than {bound} labelled URLs")
    grams = with_grams(rows.select("y", host.alias("host"), path.alias("path")), buckets).select(
        "y", "grams", F.when(F.size("grams") > 0, 1 / F.sqrt(F.size("grams"))).otherwise(0.0).alias("v")
    )
    # One row: all labelled URLs, and per bucket the places of those that hold it.
    told = grams.agg(F.sort_array(F.collect_list(F.struct("y", "grams", "v"))).alias("seen"))
    places = (
        told.select(F.posexplode("seen").alias("e", "x"))
        .select("e", F.explode(F.concat("x.grams", F.array(F.lit(buckets)))).alias("b"), "x.v")
        .groupBy("b")
        .agg(F.sort_array(F.collect_list(F.struct("e", F.when(F.col("b") == buckets, 1.0).otherwise(F.col("v")).alias("v")))).alias("at"))
    )
    every = labelled.sparkSession.range(buckets + 1).select(F.col("id").cast("int").alias("b")).join(places, "b", "left")
    held = every.agg(F.sort_array(F.collect_list(F.struct("b", "at"))).alias("held"))
    # Two rows made one.
    both = told.unionByName(held, allowMissingColumns=True)
    one = both.agg(*(F.first(c, ignorenulls=True).alias(c) for c in ("seen", "held")))
    n = F.greatest(F.size("seen"), F.lit(1))

    def step(w: Column, _: Column) -> Column:
        def missed(x: Column) -> Column:
            total = F.aggregate(x.grams, F.lit(0.0), lambda a, b: a + F.get(w, b)) * x.v + F.get(w, F.lit(buckets))
            return x.y - 1 / (1 + F.exp(-total))

        def moved(errors: Column) -> Column:
            pulled = lambda a, e: a + F.get(errors, e.e) * e.v
            return F.zip_with(
                w, "held", lambda x, h: x * (1 - RATE * PULL)
                + F.coalesce(F.aggregate(h["at"], F.lit(0.0), pulled), F.lit(0.0)) * RATE / n
            )

        # An array of one binds the errors, which would else be worked out again for every bucket.
        return F.get(F.transform(F.array(F.transform("seen", missed)), moved), F.lit(0))

    zeros = F.array_repeat(F.lit(0.0), buckets + 1)
    return one.select(F.aggregate(F.sequence(F.lit(1), F.lit(steps)), zeros, step).alias("w")).first()["w"]


def judge(
    pages: DataFrame, labelled: DataFrame | None = None, rules: Sequence[tuple[str, str]] = RULES, buckets: int = BUCKETS
) -> DataFrame:
    """One row per page: page_id, host, path, rule, score, verdict ('allow' or 'block').

    The longest rule that fits decides; where none does, a positive `score` (the log odds of being unwanted) blocks. A null
    URL, or one without ://, has an empty host and path and the score of that. Every row is judged, repeated ones and null
    ids too; columns other than page_id and url are ignored; an empty table gives no rows.
    """
    weights = train(labelled_urls(pages.sparkSession) if labelled is None else labelled, buckets)
    w = F.split(F.lit(",".join(map(repr, weights))), ",").cast("array<double>")
    host, path = host_and_path(F.col("url"))
    known = with_grams(pages.select("page_id", host.alias("host"), path.alias("path")), buckets)
    total = F.aggregate("grams", F.lit(0.0), lambda a, b: a + F.get(w, b))
    mean = F.when(F.size("grams") > 0, total / F.sqrt(F.size("grams"))).otherwise(F.lit(0.0))
    rule, ruled = rule_of(F.col("host"), F.col("path"), rules)
    return known.select(
        "page_id", "host", "path", rule.alias("rule"), (mean + F.lit(weights[-1])).alias("score"), ruled.alias("ruled")
    ).select(
        "page_id", "host", "path", "rule", "score",
        F.coalesce("ruled", F.when(F.col("score") > 0, "block").otherwise("allow")).alias("verdict"),
    )
