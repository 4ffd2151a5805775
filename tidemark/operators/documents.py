"""From record to stored bytes: document lookup, contents read once per response, attachments behind shell pages.

A document is named by its response, (doc_url, version). Very many records may have one document; its bytes are joined,
parsed and hashed for the response alone, and only what was found out comes back to the records.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import html, keys
from tidemark.functions.urls import doc_type, fetched
from tidemark.sources.staging import staged

# What names a response among the stored ones.
RESPONSE = ("doc_url", "version")
# What examining a response finds out.
FACTS = ("file_hash", "size", "attachment", "parse_error")
# Records of one key beyond which its row is broadcast to them; at most one in so many records is such a key.
CROWD = 50_000


def _versions(fetches: DataFrame) -> DataFrame:
    """Fetches with a version that always compares."""
    version = F.coalesce(F.col("fetched_at").cast("timestamp"), F.timestamp_seconds(F.lit(0)))
    return fetches.withColumns({"version": version}).withColumnRenamed("url", "doc_url")


def latest_fetches(fetches: DataFrame, urls: DataFrame) -> DataFrame:
    """(doc_url, version, copies, http_status) of the newest response per wanted URL.

    `urls` may repeat one. `copies` counts the successful responses of that moment, usually 1, or 0 where the
    newest one is a failure. Bodies are not read.
    """
    good = F.min(F.when(fetched("status"), F.col("status")))
    return (
        _versions(fetches)
        .select(*RESPONSE, "status")
        .join(urls.distinct(), "doc_url", "left_semi")
        .groupBy(*RESPONSE)
        .agg(
            F.count_if(fetched("status")).alias("copies"),
            F.coalesce(good, F.max("status")).alias("http_status"),
        )
        .groupBy("doc_url")
        .agg(F.max(F.struct("version", "copies", "http_status")).alias("_newest"))
        .select("doc_url", "_newest.*")
    )


def to_records(records: DataFrame, found: DataFrame, key: Sequence[str], crowded: DataFrame | None = None) -> DataFrame:
    """Records, whose key is never NULL, with the columns of `found`, which has a row per key: a left join.

    What a key of very many records has in `found` goes to where these lie, so that they meet in no task; all others take
    a shuffle. Spark splits a hot key by its bytes, of which rows that are alike have next to none in a shuffle. `found` and
    `crowded` (the hot keys, else counted here) are read twice.
    """
    if crowded is None:
        crowded = records.groupBy(*key).agg(F.count("*").alias("_n")).where(F.col("_n") > CROWD).select(*key)
    columns = [*records.columns, *(c for c in found.columns if c not in key)]
    near = records.join(F.broadcast(crowded.join(found, list(key), "left")), list(key)).select(*columns)
    rest = records.join(F.broadcast(crowded), list(key), "left_anti").join(found, list(key), "left")
    return near.unionByName(rest.select(*columns))


def locate(items: DataFrame, fetches: DataFrame, latest: DataFrame | None = None) -> DataFrame:
    """Add which response holds each record's document (`version`, `copies`, `http_status`); narrow.

    `latest` (latest_fetches of their URLs) may be given as a stored table; it is read more than once.
    """
    linked = items.where(F.col("doc_url").isNotNull())
    if latest is None:
        latest = latest_fetches(fetches, linked.select("doc_url"))
    unlinked = items.where(F.col("doc_url").isNull())
    return to_records(linked, latest, ["doc_url"]).unionByName(unlinked, allowMissingColumns=True)


def requested(items: DataFrame, fetches: DataFrame) -> DataFrame:
    """The URLs of the records, located, one row each with its number of `records`: counted before anything is joined."""
    urls = items.where(F.col("doc_url").isNotNull()).groupBy("doc_url").agg(F.count("*").alias("records"))
    return urls.join(latest_fetches(fetches, urls.select("doc_url")), "doc_url", "left")


def responses(located: DataFrame, *facts: Column) -> DataFrame:
    """The responses to read, one row each however many records share it, with `facts` aggregated over those records."""
    wanted = located.where(F.col("copies") > 0)
    return wanted.groupBy(*RESPONSE, "copies").agg(F.count("*").alias("records"), *facts)


def contents(wanted: DataFrame, fetches: DataFrame) -> DataFrame:
    """Add the bytes of each response: the only join with bodies.

    Given responses that were stored in between, Spark knows their size when it plans: few are broadcast to the scan
    of the bodies, many take one shuffle.
    """
    columns = wanted.columns
    bodies = _versions(fetches).where(fetched("status")).select(*RESPONSE, F.col("body").alias("content"))
    found = wanted.join(bodies, list(RESPONSE)).select(*columns, "content")
    # Responses stored twice for one moment are reduced to one; without any, Spark drops
    # this branch as soon as it sees that no row asks for it.
    several = wanted.where(F.col("copies") > 1).join(bodies, list(RESPONSE)).select(*columns, "content")
    named = [c for c in columns if c not in RESPONSE]
    single = several.groupBy(*RESPONSE).agg(*(F.first(c).alias(c) for c in named), F.max("content").alias("content"))
    return found.where(F.col("copies") == 1).unionByName(single)


def examine(held: DataFrame) -> DataFrame:
    """Hash each response, and find the html pages that are empty shells around a pdf/doc.

    Adds FACTS. A shell has an `attachment` and gives up its content; a response that is no readable page keeps its
    bytes, and the finding stands in `parse_error`. Binaries are not handed to Python: the UDF sees NULL in their place.
    """
    page = F.when(doc_type("doc_url") == "html", F.col("content"))
    link = F.col("_link")
    kept = [c for c in held.columns if c != "content"]
    return (
        held.withColumn("_link", html.shell_attachment(page, F.col("doc_url")))
        .select(
            *kept,
            F.when(link["value"].isNull(), F.col("content")).alias("content"),
            link["value"].alias("attachment"),
            link["error"].alias("parse_error"),
        )
        .withColumns({"file_hash": keys.file_hash("content"), "size": F.length("content").cast("bigint")})
    )


def outcomes(located: DataFrame, examined: DataFrame, *more: str) -> DataFrame:
    """What became of each record: `status`, the facts of its response, and `more` columns of `examined`.

    'scraped', also for a record that has no URL; 'rerouted' for one whose page is a shell; 'failed' where the newest
    response is missing or not a success. No bytes are touched.
    """
    answered = F.col("doc_url").isNotNull() & F.col("version").isNotNull()
    told = to_records(located.where(answered), _facts(examined, *more), RESPONSE)
    return _judged(told.unionByName(located.where(~answered), allowMissingColumns=True))


def _facts(examined: DataFrame, *more: str) -> DataFrame:
    return examined.select(*RESPONSE, *FACTS, *more, F.lit(True).alias("_held"))


def _judged(told: DataFrame) -> DataFrame:
    status = (
        F.when(F.col("doc_url").isNull(), "scraped")
        .when(F.col("_held").isNull(), "failed")
        .when(F.col("attachment").isNotNull(), "rerouted")
        .otherwise("scraped")
    )
    return told.withColumn("status", status).drop("_held", "version", "copies")


def resolve(items: DataFrame, fetches: DataFrame) -> DataFrame:
    """Every record with what became of its document: `status`, `http_status` and FACTS, without bytes.

    That is found out by URL and stored, one row each, and comes back to the records in one join.
    """
    asked = requested(items, fetches)
    held = examine(contents(asked.where(F.col("copies") > 0), fetches))
    told = staged(_judged(asked.join(_facts(held), list(RESPONSE), "left")))
    crowded = told.where(F.col("records") > CROWD).select("doc_url")
    linked = to_records(items.where(F.col("doc_url").isNotNull()), told.drop("records"), ["doc_url"], crowded)
    unlinked = items.where(F.col("doc_url").isNull()).withColumn("status", F.lit("scraped"))
    return linked.unionByName(unlinked, allowMissingColumns=True)


def attachments(shells: DataFrame) -> DataFrame:
    """The 'rerouted' records, re-aimed at their attachment."""
    columns = [c for c in shells.columns if c not in ("status", "http_status", *FACTS)]
    return (
        shells.where(F.col("status") == "rerouted")
        .select(*columns, "attachment")
        .withColumn("doc_url", F.col("attachment"))
        .withColumn("doc_type", doc_type("attachment"))
        .drop("attachment")
    )


def follow_attachment(shells: DataFrame, fetches: DataFrame) -> DataFrame:
    """Resolve the attachments. One hop only, as an attachment is never html."""
    return resolve(attachments(shells), fetches)
