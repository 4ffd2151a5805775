"""A search site derived from the pages table: listings, documents, attachments.

Ten consecutive pages make one listing page; listing pages are dealt to twelve cells
(four bodies, three months). The shape of a page's URL decides how its record looks:

    .../1234.html       identifier padded with white space, blank for Spanish
    .../1234/           no link, identifier only in .refNO; none at all for French
    ...?page=2&ref=x    empty shell, the document is a pdf attachment
    ...#top             the document is not delivered (404)
    anything else       plain record and page
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import day_param
from tidemark.functions.urls import search_url
from tidemark.schemas import BODIES

CARDS_PER_PAGE = 10
CELLS = 12
BASE_URL = "https://search.example.org/find"
# The months of the cells.
START, END = date(2024, 1, 1), date(2024, 4, 1)
_NAMES = list(BODIES.values())


def padded() -> Column:
    return F.col("url").endswith(".html")


def unlinked() -> Column:
    return F.col("url").endswith("/")


def is_shell() -> Column:
    return F.col("url").contains("?page=2")


def lost() -> Column:
    return F.col("url").endswith("#top")


# The same derivation for the SQL side.
SITE_SQL = f"""
    WITH site AS (
        SELECT *, page_id // {CARDS_PER_PAGE} AS listing, (page_id // {CARDS_PER_PAGE}) % {CELLS} AS cell,
            regexp_extract(url, '/([a-z][a-z])/', 1) AS lang, regexp_extract(url, '([0-9]+)', 1) AS num,
            url LIKE '%.html' AS padded, url LIKE '%/' AS unlinked, url LIKE '%?page=2%' AS shell,
            url LIKE '%#top' AS lost
        FROM pages
    ), cards AS (
        SELECT page_id, html, url, shell, lost, cell,
            (cell % 4)::int AS body_order, {_NAMES!r}[cell % 4 + 1] AS body,
            make_date(2024, 1 + cell // 4, 1) AS partition_date,
            listing // {CELLS} + 1 AS page, (page_id % {CARDS_PER_PAGE})::int AS position,
            CASE WHEN unlinked AND lang = 'fr' THEN NULL WHEN padded AND lang = 'es' THEN ''
                ELSE upper(lang) || ' ' || num END AS identifier,
            trim(regexp_replace(replace(replace(replace(regexp_extract(html, '<h1>([^<]*)</h1>', 1),
                '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;?', '&', 'g')) AS description,
            CASE WHEN NOT unlinked THEN url END AS doc_url,
            CASE WHEN NOT unlinked THEN 'html' END AS doc_type,
            regexp_extract(url, '^(https?://[^/]+)', 1) || '/files/' || lang || num || '.pdf' AS attachment
        FROM site
    )
"""


def records(pages: DataFrame) -> DataFrame:
    """Per page: its cell, place, and what its card shows."""
    listing = F.floor(F.col("page_id") / CARDS_PER_PAGE)
    cell = (listing % CELLS).cast("int")
    lang = F.regexp_extract("url", "/([a-z][a-z])/", 1)
    number = F.regexp_extract("url", "([0-9]+)", 1)
    reference = F.concat(F.upper(lang), F.lit(" "), number)
    return pages.select(
        "page_id", "url", "html",
        (cell % 4).cast("int").alias("body_order"),
        F.element_at(F.array(*map(F.lit, _NAMES)), cell % 4 + 1).alias("body"),
        F.make_date(F.lit(2024), F.floor(cell / 4).cast("int") + 1, F.lit(1)).alias("partition_date"),
        (F.floor(listing / CELLS) + 1).cast("bigint").alias("page"),
        (F.col("page_id") % CARDS_PER_PAGE).cast("int").alias("position"),
        F.when(unlinked() & (lang == "fr"), F.lit(None).cast("string"))
        .when(padded() & (lang == "es"), "")
        .otherwise(reference).alias("identifier"),
        F.regexp_extract("html", "<h1>([^<]*)</h1>", 1).alias("description"),
        F.when(~unlinked(), F.col("url")).alias("doc_url"),
        F.when(~unlinked(), "html").alias("doc_type"),
    )


def listing_pages(pages: DataFrame) -> DataFrame:
    """Listing pages with their markup; a page gathers at most ten cards."""
    rows = records(pages).drop("html")
    place = ("body", "body_order", "partition_date", "page")
    href = F.replace(F.col("url"), F.lit("&"), F.lit("&amp;"))
    shown = F.when(padded(), F.concat(F.lit("\n &nbsp;"), "identifier", F.lit(" \t"))).otherwise(F.col("identifier"))
    title = F.when(
        ~unlinked(), F.concat(F.lit('<a href="'), href, F.lit('">'), shown, F.lit("</a>"))
    ).otherwise("no document")
    card = F.concat(
        F.lit('<li class="result each-item"><h2 class="title">'), title, F.lit("</h2>"),
        F.lit('<span class="date"> 01/02/2024 </span><p class="description">'), "description",
        F.lit("<br>more</p>"),
        F.when(unlinked() & F.col("identifier").isNotNull(),
               F.concat(F.lit('<span class="refNO">'), "identifier", F.lit("</span>"))).otherwise(""),
        F.lit("</li>"),
    )
    gathered = rows.groupBy(*place).agg(
        F.sort_array(F.collect_list(F.struct("position", card.alias("markup")))).alias("_cards")
    )
    # One row per cell, of which there are twelve: the markup is not shuffled to meet them.
    totals = F.broadcast(rows.groupBy("body", "partition_date").agg(F.count("*").alias("announced")))
    body = F.concat(
        F.lit("<html><body><ul>"),
        F.array_join(F.transform("_cards", lambda c: c["markup"]), "\n"),
        F.lit("</ul><p>Shows 1 to 10 of \n"), F.col("announced"), F.lit(" results</p></body></html>"),
    )
    return gathered.join(totals, ["body", "partition_date"]).select(
        *place, F.lit("https://search.example.org/").alias("url"), body.cast("binary").alias("content")
    )


def searches(pages: DataFrame) -> DataFrame:
    """The listing pages as responses to the searches that a plan over their months makes."""
    number = F.element_at(F.array(*map(F.lit, BODIES)), F.col("body_order") + 1)
    url = search_url(BASE_URL, day_param("partition_date"), day_param(F.last_day("partition_date")), number, F.col("page"))
    return listing_pages(pages).select(
        url.alias("url"), F.lit(200).alias("status"), F.col("content").alias("body"), F.lit(None).cast("timestamp").alias("fetched_at"),
        "page", "body_order", "partition_date",
    )


SHELL_PAGE = (
    '<html><body><div class="content main">\n&nbsp;<!-- moved --></div>'
    '<div class="related-items related-file"><p><a class="button download" href="/files/{}.pdf">'
    "Download</a></p></div></body></html>"
)


def fetches(pages: DataFrame) -> DataFrame:
    """Document responses: the page itself, a shell for some, and the shells' attachments."""
    number = F.concat(F.regexp_extract("url", "/([a-z][a-z])/", 1), F.regexp_extract("url", "([0-9]+)", 1))
    before, after = SHELL_PAGE.split("{}")
    shell = F.concat(F.lit(before), number, F.lit(after))
    host = F.regexp_extract("url", "^(https?://[^/]+)", 1)
    attachment = F.concat(host, F.lit("/files/"), number, F.lit(".pdf"))
    served = F.array(
        F.struct(
            F.col("url").alias("url"),
            F.when(lost(), 404).otherwise(200).alias("status"),
            F.when(is_shell(), shell).otherwise(F.col("html")).cast("binary").alias("body"),
        ),
        F.struct(attachment.alias("url"), F.lit(200).alias("status"), F.col("html").cast("binary").alias("body")),
    )
    wanted = F.when(is_shell(), served).otherwise(F.slice(served, 1, 1))
    return (
        pages.select(F.explode(wanted).alias("_fetch"))
        .select("_fetch.*")
        .withColumn("fetched_at", F.lit(None).cast("timestamp"))
    )
