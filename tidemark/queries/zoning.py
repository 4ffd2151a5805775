"""Listing, document, landing and clean queries over the pages."""

from __future__ import annotations

import uuid
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import html, keys
from tidemark.functions import urls as url_functions
from tidemark.operators import audit, documents, listing, reconcile
from tidemark.plans import landing, transform, zones
from tidemark.queries import site
from tidemark.queries.registry import load, query
from tidemark.queries.site import SITE_SQL
from tidemark.schemas import CLEAN_METADATA, FETCHES, FILES, LANDING_METADATA
from tidemark.sources import cells, reclaim, tables
from tidemark.sources.fetches import read_fetches
from tidemark.sources.staging import shared_folder, staged


def _stamp() -> Column:
    return F.lit("2024-06-01 00:00:00").cast("timestamp")


# Body element of a page (to the end of text where its end tag is missing), no scripts.
_CLEAN_SQL = r"""regexp_replace(coalesce(nullif(regexp_extract({0}, '(?s)<body[^>]*>.*?</body>'), ''),
    regexp_extract({0}, '(?s)<body[^>]*>.*')), '(?s)<(script|style)[^>]*>.*?</(script|style)>', '', 'g')"""


@query(
    f"""
    WITH c AS (SELECT page_id, {_CLEAN_SQL.format('html')} AS clean FROM pages)
    SELECT page_id, sha256(clean) AS clean_hash, strlen(clean)::bigint AS clean_size,
           strlen(html)::bigint AS raw_size FROM pages JOIN c USING (page_id)
    """
)
def clean_html_body(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No page has the container: the body is kept."""
    pages = load(spark, sf_dir, "pages").select("page_id", "html")
    return pages.withColumn("_clean", html.clean_html(F.col("html"))["value"]).select(
        "page_id",
        keys.file_hash("_clean").alias("clean_hash"),
        F.octet_length("_clean").cast("bigint").alias("clean_size"),
        F.octet_length("html").cast("bigint").alias("raw_size"),
    )


_OPENING = '<div id="d" class="x content"><script>var end="</div>";</script><div>'


@query(
    r"""
    SELECT page_id, sha256(replace(replace(regexp_extract(html, '(?s)<article>.*?</article>'),
        '<article>', '<div id="d" class="x content"><div>'), '</article>', '</div></div>')) AS clean_hash FROM pages
    """
)
def clean_html_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles turned into nested containers: exactly the outer one is kept."""
    page = F.replace("html", F.lit("<article>"), F.lit(_OPENING))
    page = F.replace(page, F.lit("</article>"), F.lit("</div></div>"))
    pages = load(spark, sf_dir, "pages").select("page_id", page.alias("html"))
    return pages.select(
        "page_id", keys.file_hash(html.clean_html(F.col("html"))["value"]).alias("clean_hash")
    )


@query(
    """
    SELECT page_id, CASE
        WHEN url LIKE '%/' THEN 'doc' WHEN url LIKE '%?page=2%' THEN 'pdf' WHEN url LIKE '%?utm%' THEN 'doc'
        WHEN url LIKE '%#top' THEN 'html' WHEN url LIKE '%.html' THEN NULL ELSE 'pdf' END AS doc_type
    FROM pages
    """
)
def doc_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page URLs given all kinds of file names, in path, query and fragment."""
    return _typed(load(spark, sf_dir, "pages")).select("page_id", "doc_type")


def _typed(pages: DataFrame) -> DataFrame:
    url = F.col("url")
    link = (
        F.when(url.endswith("/"), F.concat(url, F.lit("my ruling.DocX")))
        .when(url.contains("?page=2"), F.replace(url, F.lit("?"), F.lit(".PDF?file=a.html&")))
        .when(url.contains("?utm"), F.replace(url, F.lit("?"), F.lit(".doc;v=1.pdf?")))
        .when(url.endswith("#top"), F.concat(F.replace(url, F.lit("#top"), F.lit("?f=x.pdf#y.doc"))))
        .when(url.endswith(".html"), F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit(" "), url, F.lit(".p\ndf")))
    )
    return pages.select("page_id", "url", url_functions.doc_type(link).alias("doc_type"))


_TYPES_SQL = """
    WITH t AS (SELECT *, CASE
        WHEN url LIKE '%/' THEN 'doc' WHEN url LIKE '%?page=2%' THEN 'pdf' WHEN url LIKE '%?utm%' THEN 'doc'
        WHEN url LIKE '%#top' THEN 'html' WHEN url LIKE '%.html' THEN NULL ELSE 'pdf' END AS doc_type,
        'Board ' || upper(regexp_extract(url, '/([a-z][a-z])/', 1)) || ' Cases' AS body,
        CASE WHEN url NOT LIKE '%?page=2%' THEN 'ADJ ' || page_id || ' A' END AS identifier,
        make_date(2024, length(regexp_extract(url, '//([^/]+)', 1)) % 12 + 1, 1) AS partition_date
        FROM pages)
"""


def _keyed(pages: DataFrame) -> DataFrame:
    lang = F.upper(F.regexp_extract("url", "/([a-z][a-z])/", 1))
    month = F.length(F.regexp_extract("url", "//([^/]+)", 1)) % 12 + 1
    return _typed(pages).select(
        "page_id",
        "doc_type",
        F.concat(F.lit("Board "), lang, F.lit(" Cases")).alias("body"),
        F.when(~F.col("url").contains("?page=2"), F.concat(F.lit("ADJ "), "page_id", F.lit(" A"))).alias("identifier"),
        F.make_date(F.lit(2024), month, F.lit(1)).alias("partition_date"),
    )


@query(_TYPES_SQL + "SELECT doc_type, count(*) AS records FROM t GROUP BY doc_type")
def doc_type_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _typed(load(spark, sf_dir, "pages")).groupBy("doc_type").agg(F.count("*").alias("records"))


@query(
    _TYPES_SQL
    + """SELECT page_id,
        CASE coalesce(doc_type, 'html') WHEN 'html' THEN 'text/html' WHEN 'pdf' THEN 'application/pdf'
            ELSE 'application/msword' END AS landing_type,
        CASE doc_type WHEN 'html' THEN 'text/html' WHEN 'pdf' THEN 'application/pdf'
            WHEN 'doc' THEN 'application/msword' ELSE 'application/octet-stream' END AS clean_type FROM t"""
)
def content_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _keyed(load(spark, sf_dir, "pages")).select(
        "page_id",
        keys.content_type(keys.extension("doc_type")).alias("landing_type"),
        keys.content_type("doc_type").alias("clean_type"),
    )


@query(
    _TYPES_SQL
    + """SELECT page_id, replace(lower(body), ' ', '-') || '/' || partition_date || '/'
        || coalesce(identifier, 'None') || '.' || coalesce(doc_type, 'html') AS file_path FROM t"""
)
def landing_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _keyed(load(spark, sf_dir, "pages")).select("page_id", keys.landing_key().alias("file_path"))


@query(
    _TYPES_SQL
    + """SELECT page_id, replace(lower(body), ' ', '-') || '/' || partition_date || '/'
        || replace(identifier, ' ', '') || '.' || coalesce(doc_type, 'html') AS file_path FROM t"""
)
def clean_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _keyed(load(spark, sf_dir, "pages")).select("page_id", keys.clean_key().alias("file_path"))


@query(
    SITE_SQL
    + """SELECT body, partition_date, page, position, identifier, description, '01/02/2024' AS published_date,
         doc_url, doc_type FROM cards"""
)
def parse_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cards read back from the markup of listing pages."""
    pages = listing.read_cards(site.listing_pages(load(spark, sf_dir, "pages")))
    return listing.parse_cards(pages).drop("body_order")


@query(
    SITE_SQL
    + """SELECT page_id, CASE WHEN doc_url IS NULL THEN 'scraped' WHEN lost THEN 'failed' WHEN shell THEN 'rerouted'
            ELSE 'scraped' END AS status, CASE WHEN lost THEN 404 WHEN doc_url IS NOT NULL THEN 200 END AS http_status,
        CASE WHEN doc_url IS NOT NULL AND NOT lost AND NOT shell THEN sha256(html) END AS file_hash,
        CASE WHEN doc_url IS NOT NULL AND NOT lost AND NOT shell THEN strlen(html)::bigint END AS size,
        CASE WHEN shell THEN attachment END AS attachment FROM cards"""
)
def resolve_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every record with what became of its document; empty pages give up theirs and name the attachment."""
    pages = load(spark, sf_dir, "pages")
    items = site.records(pages).select("page_id", "doc_url")
    return documents.resolve(items, site.fetches(pages)).select(
        "page_id", "status", "http_status", "file_hash", "size", "attachment"
    )


_SHARED_SQL = """
    WITH items AS (
        SELECT 'https://docs.example.org/' || CASE l_returnflag WHEN 'N' THEN 0 ELSE l_partkey END AS doc_url FROM lineitem
    ), served AS (
        SELECT 'https://docs.example.org/' || doc_id AS doc_url, CASE WHEN doc_id % 5 = 3 THEN 503 ELSE 200 END AS http_status,
            sha256(text) AS file_hash, strlen(text)::bigint AS size FROM documents
    )
"""


def _shared(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Line items as records, about half of them with one document, and the documents as responses."""
    number = F.when(F.col("l_returnflag") == "N", F.lit(0)).otherwise(F.col("l_partkey"))
    host = F.lit("https://docs.example.org/")
    items = load(spark, sf_dir, "lineitem").select(F.concat(host, number.cast("string")).alias("doc_url"))
    responses = load(spark, sf_dir, "documents").select(
        F.concat(host, F.col("doc_id").cast("string")).alias("url"),
        F.when(F.col("doc_id") % 5 == 3, 503).otherwise(200).alias("status"),
        F.col("text").cast("binary").alias("body"),
        F.lit(None).cast("timestamp").alias("fetched_at"),
    )
    return items, responses


@query(
    _SHARED_SQL
    + """SELECT doc_url, count(*) AS records, any_value(file_hash) AS file_hash, any_value(size) AS size
        FROM items JOIN served USING (doc_url) WHERE http_status = 200 GROUP BY doc_url"""
)
def shared_contents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of bytes of very many records: one per response, also of the one that half of them share."""
    items, fetches = _shared(spark, sf_dir)
    held = documents.contents(documents.requested(items, fetches).where(F.col("copies") > 0), fetches)
    return held.select("doc_url", "records", keys.file_hash("content").alias("file_hash"), F.length("content").cast("bigint").alias("size"))


@query(
    _SHARED_SQL
    + """SELECT CASE WHEN http_status = 200 THEN 'scraped' ELSE 'failed' END AS status, http_status,
            CASE WHEN http_status = 200 THEN file_hash END AS file_hash, count(*) AS records
        FROM items LEFT JOIN served USING (doc_url) GROUP BY ALL"""
)
def shared_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What became of those records: the findings of each response come back to all that share it."""
    items, fetches = _shared(spark, sf_dir)
    return documents.resolve(items, fetches).groupBy("status", "http_status", "file_hash").agg(F.count("*").alias("records"))


@query(
    SITE_SQL
    + """SELECT page_id, attachment AS doc_url, 'pdf' AS doc_type, 'scraped' AS status, sha256(html) AS file_hash
         FROM cards WHERE shell"""
)
def shell_reroute(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Empty pages found among the documents, and the attachments stored instead."""
    pages = load(spark, sf_dir, "pages")
    items = site.records(pages).select("page_id", "doc_url", "doc_type")
    fetches = site.fetches(pages)
    followed = documents.follow_attachment(staged(documents.resolve(items, fetches)), fetches)
    return followed.select("page_id", "doc_url", "doc_type", "status", "file_hash")


_REQUESTS_SQL = (
    SITE_SQL
    + """, stored AS (SELECT DISTINCT identifier FROM cards WHERE description < 'F' AND identifier <> ''),
    firsts AS (
        SELECT * FROM cards WHERE coalesce(identifier, '') <> ''
        QUALIFY row_number() OVER (PARTITION BY identifier ORDER BY body_order, partition_date, page, position) = 1
        UNION ALL SELECT * FROM cards WHERE coalesce(identifier, '') = ''
    ), requests AS (
        SELECT * FROM firsts WHERE identifier IS NULL OR identifier NOT IN (SELECT identifier FROM stored)
    ), records AS (
        SELECT *, CASE WHEN doc_url IS NULL THEN 'scraped' WHEN lost THEN 'failed' ELSE 'scraped' END AS status,
            CASE WHEN lost THEN 404 WHEN doc_url IS NOT NULL THEN 200 END AS http_status,
            CASE WHEN shell THEN attachment ELSE doc_url END AS final_url,
            CASE WHEN shell THEN 'pdf' ELSE doc_type END AS final_type,
            doc_url IS NOT NULL AND NOT lost AS has_content,
            replace(lower(body), ' ', '-') || '/' || partition_date || '/' || coalesce(identifier, 'None') || '.' AS stem
        FROM requests
    )
    """
)


def _storing(*names: str) -> landing.Stage:
    """Stages of which the named ones are stored, as a run stores all: what several later steps need is worked out once."""
    return lambda rows, name: staged(rows.drop("content")) if name in names else rows


def _crawled(spark: SparkSession, searches: DataFrame, *stored: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(grid, pages, cards) of a crawl of the site by its body dimension, months and search URLs."""
    responses = searches.drop("page", "body_order", "partition_date")
    stage = _storing("listing_first", *stored)
    return landing.crawl(listing.bodies(spark), responses, site.BASE_URL, site.START, site.END, 1, stage)


def _known(pages: DataFrame, cards: DataFrame) -> DataFrame:
    """First cards of each key; records described with A to E are stored already."""
    early = site.records(pages).where(F.col("description") < "F").select("identifier").distinct()
    stored = early.select(
        *(
            F.col("identifier") if f.name == "identifier" else F.lit(None).cast(f.dataType).alias(f.name)
            for f in LANDING_METADATA.fields
        )
    )
    return landing.firsts(cards, lambda _: stored, lambda rows, _: rows)


@query(
    _REQUESTS_SQL
    + """SELECT body, partition_date, page, position, identifier, description, final_url AS doc_url, final_type AS doc_type,
        status, http_status, CASE WHEN has_content THEN stem || final_type END AS file_path,
        CASE WHEN has_content THEN sha256(html) END AS file_hash,
        CASE WHEN has_content THEN strlen(html)::bigint END AS size,
        CASE WHEN has_content THEN CASE final_type WHEN 'pdf' THEN 'application/pdf' ELSE 'text/html' END END AS content_type,
        CASE WHEN has_content THEN TIMESTAMP '2024-06-01 00:00:00' END AS scraped_at, has_content AS write_file,
        CASE WHEN has_content THEN body_order || '-' || partition_date || '-' || page || '-' || position END AS file_row
        FROM records"""
)
def landing_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A landing run over the site: planned searches to listing pages, cards, skip, dedup, resolve, follow, key and hash."""
    pages = load(spark, sf_dir, "pages")
    _, _, cards = _crawled(spark, site.searches(pages))
    wanted = staged(landing.requests(_known(pages, cards), "skip"))
    return landing.build(wanted, site.fetches(pages), "run", _stamp(), _storing("run_direct")).select(
        "body", "partition_date", "page", "position", "identifier", "description", "doc_url", "doc_type", "status", "http_status",
        "file_path", "file_hash", "size", "content_type", "scraped_at", "write_file", "file_row",
    )


@query(
    _REQUESTS_SQL
    + """SELECT c.body, c.partition_date, c.page, c.position, c.identifier, CASE
            WHEN coalesce(c.identifier, '') <> '' AND f.position IS NULL THEN 'repeated'
            WHEN r.position IS NULL THEN 'stored' ELSE r.status END AS reason
        FROM cards c LEFT JOIN firsts f USING (body, partition_date, page, position)
        LEFT JOIN records r USING (body, partition_date, page, position)"""
)
def outcome_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every card of the site with the reason of what became of it."""
    pages = load(spark, sf_dir, "pages")
    _, _, cards = _crawled(spark, site.searches(pages))
    cards = staged(cards)
    known = staged(_known(pages, cards))
    wanted = landing.requests(known, "skip").select("row", "doc_url")
    # Attachments of the site are always there: the first hop decides.
    told = documents.outcomes(
        documents.locate(wanted, site.fetches(pages)),
        documents.latest_fetches(site.fetches(pages), wanted.select("doc_url")).where("copies > 0").select(
            *documents.RESPONSE, *(F.lit(None).cast(FILES[c].dataType).alias(c) for c in documents.FACTS)
        ),
    )
    return reconcile.ledger(cards, known, told).select("body", "partition_date", "page", "position", "identifier", "reason")


@query(
    SITE_SQL
    + """, listed AS (
        SELECT DISTINCT body, partition_date, page, (partition_date, page) AS k, page > 1 AND (page + body_order) % 3 = 0 AS refused FROM cards
    )
    SELECT 'run_started' AS event, NULL::varchar AS body, NULL::varchar AS "partition", NULL::int AS status,
        NULL::varchar AS cause, 1::bigint AS events
    UNION ALL SELECT 'partition_found', body, partition_date::varchar, NULL, NULL, 1 FROM listed WHERE page = 1
    UNION ALL SELECT 'listing_failed', body, partition_date::varchar, 503, 'http 503', count(*) FROM listed WHERE refused GROUP BY ALL"""
)
def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log of a run that failed and was repeated: the second attempt's events count, the first one's do not."""
    pages = load(spark, sf_dir, "pages")
    # Some later listing pages answer 503.
    refused = (F.col("page") > 1) & ((F.col("page") + F.col("body_order")) % 3 == 0)
    searches = site.searches(pages).withColumn("status", F.when(refused, 503).otherwise(200))
    grid, read, _ = _crawled(spark, searches, "listing_rest")
    records = spark.createDataFrame([], "partition_date date, body string, identifier string, doc_url string, status string, http_status int, parse_error string")
    started = landing.run_started(grid, 1, _stamp())
    broken = started.unionByName(
        spark.range(1).select(*reconcile.event("run_failed", "error", _stamp()), F.lit("disk full").alias("cause")), allowMissingColumns=True
    )
    done = started
    for rows in (landing.partition_found(read, _stamp()), landing.failures(read, records, _stamp())):
        done = done.unionByName(rows, allowMissingColumns=True)
    log = None
    for attempt, told in enumerate((broken, done), 1):
        told = told.withColumns({"run_id": F.lit("r1"), "attempt": F.lit(attempt)})
        log = told if log is None else log.unionByName(told, allowMissingColumns=True)
    by = ("event", "body", "partition", "status", "cause")
    return reconcile.last_attempts(log).groupBy(*by).agg(F.count("*").alias("events"))


_RECORDS_SQL = (
    SITE_SQL
    + f""", landing AS (
        SELECT page_id, body, partition_date, identifier, html, CASE WHEN shell THEN 'pdf' ELSE 'html' END AS doc_type,
            replace(lower(body), ' ', '-') || '/' || partition_date || '/' || page_id || '.x' AS file_path,
            NOT lost AS stored
        FROM cards
    ), clean AS (
        SELECT page_id, body, partition_date, identifier, doc_type, stored,
            CASE WHEN NOT stored THEN 'file not found' WHEN identifier IS NULL
                THEN 'no key: body or identifier is missing' END AS error,
            CASE WHEN doc_type = 'html' THEN {_CLEAN_SQL.format('html')} ELSE html END AS content, html
        FROM landing
    )
    """
)


def _zones(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Landing metadata and files of all pages; the undelivered ones have no file."""
    rows = site.records(pages)
    slug = keys.body_slug("body")
    path = F.concat(slug, F.lit("/"), F.col("partition_date").cast("string"), F.lit("/"), "page_id", F.lit(".x"))
    metadata = rows.select(
        "page_id", "body", "partition_date", "identifier",
        F.when(site.is_shell(), "pdf").otherwise("html").alias("doc_type"), path.alias("file_path"),
    )
    content = F.col("html").cast("binary")
    files = rows.where(~site.lost()).select(
        path.alias("file_path"), F.when(site.is_shell(), "pdf").otherwise("html").alias("doc_type"),
        content.alias("content"), F.octet_length("html").cast("bigint").alias("size"),
    )
    return metadata, files


def _clean(pages: DataFrame) -> DataFrame:
    metadata, files = _zones(pages)
    return transform.clean_records(metadata, transform.clean_contents(files), _stamp(), on={"file_path": "file_path"})


@query(
    _RECORDS_SQL
    + """SELECT page_id, identifier, doc_type, error,
        CASE WHEN error IS NULL THEN replace(lower(body), ' ', '-') || '/' || partition_date || '/'
            || replace(identifier, ' ', '') || '.' || doc_type END AS file_path,
        CASE WHEN error IS NULL THEN sha256(content) END AS file_hash,
        CASE WHEN error IS NULL THEN strlen(content)::bigint END AS size,
        CASE WHEN error IS NULL THEN CASE doc_type WHEN 'pdf' THEN 'application/pdf' ELSE 'text/html' END END AS content_type
        FROM clean"""
)
def clean_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing records to clean records, with failures in their own rows."""
    return _clean(load(spark, sf_dir, "pages")).select(
        "page_id", "identifier", "doc_type", "error", "file_path", "file_hash", "size", "content_type"
    )


@query(
    _RECORDS_SQL
    + """SELECT count(*) AS read, count(*) FILTER (WHERE error IS NULL) AS transformed,
        count(error) AS failed FROM clean"""
)
def transform_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transform.stats(_clean(load(spark, sf_dir, "pages")))


@query(
    _RECORDS_SQL
    + """SELECT page_id, body, partition_date FROM landing
        WHERE partition_date >= DATE '2024-02-01' AND partition_date < DATE '2024-04-01'"""
)
def range_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    metadata, _ = _zones(load(spark, sf_dir, "pages"))
    return transform.select_range(metadata, date(2024, 2, 1), date(2024, 4, 1)).select(
        "page_id", "body", "partition_date"
    )


@query(
    _RECORDS_SQL
    + """SELECT 'landing' AS zone, count(*) AS objects, sum(strlen(html))::bigint AS bytes FROM landing WHERE stored
        UNION ALL SELECT 'clean', count(*), sum(strlen(content))::bigint FROM clean WHERE error IS NULL"""
)
def zone_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = load(spark, sf_dir, "pages")
    _, files = _zones(pages)
    clean = _clean(pages).where(F.col("error").isNull())
    return audit.zone_totals(
        files.select(F.lit("landing").alias("zone"), "size").unionByName(
            clean.select(F.lit("clean").alias("zone"), "size")
        )
    )


@query(
    _RECORDS_SQL
    + """, n AS (SELECT page_id, error FROM clean)
    SELECT *, landing_only = 0 AND clean_only = 0 AND landing_files = clean_files AS parity, clean_bytes < landing_bytes AS shrunk FROM (
    SELECT count(*) AS landing_records, count(*) FILTER (WHERE error IS NULL) AS clean_records,
        (SELECT count(*) FROM landing WHERE page_id NOT IN (SELECT page_id FROM n WHERE error IS NULL)) AS landing_only,
        (SELECT count(*) FROM n WHERE error IS NULL AND page_id NOT IN (SELECT page_id FROM landing)) AS clean_only,
        (SELECT count(*) FROM landing WHERE stored) AS landing_files,
        count(*) FILTER (WHERE error IS NULL) AS clean_files,
        (SELECT sum(strlen(html))::bigint FROM landing WHERE stored) AS landing_bytes,
        (SELECT sum(strlen(content))::bigint FROM clean WHERE error IS NULL) AS clean_bytes
        FROM n)"""
)
def audit_zone_parity(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = load(spark, sf_dir, "pages")
    size = F.when(~site.lost(), F.octet_length("html"))
    landed = site.records(pages).select("page_id", size.alias("size"))
    return audit.zone_parity(landed, _clean(pages).where(F.col("error").isNull()), key="page_id")


@query(
    """
    WITH files AS (
        SELECT source AS body_slug, 'first' AS run_id, doc_id, strlen(text)::bigint AS size FROM documents
        UNION ALL SELECT source, 'second', d.doc_id, strlen(text)::bigint FROM documents d JOIN labels USING (doc_id) WHERE toxic = 1
    ), pointers AS (
        SELECT doc_id, CASE WHEN doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1) THEN 'second' ELSE 'first' END AS run_id
        FROM documents WHERE lang <> 'fr'
    )
    SELECT run_id, body_slug, count(*) AS records, sum(size)::bigint AS bytes, count(*) FILTER (WHERE p.doc_id IS NULL) AS dead_records,
        coalesce(sum(size) FILTER (WHERE p.doc_id IS NULL), 0)::bigint AS dead_bytes
    FROM files LEFT JOIN pointers p USING (run_id, doc_id) GROUP BY run_id, body_slug
    """
)
def reclaimable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts stored by one run, the toxic ones again by a second; French records were dropped since."""
    texts = load(spark, sf_dir, "documents").withColumnRenamed("source", "body_slug")
    again = load(spark, sf_dir, "labels").where("toxic = 1").select("doc_id")
    size = F.octet_length("text").cast("bigint").alias("size")
    file_row = F.col("doc_id").cast("string").alias("file_row")
    stored = [
        rows.select(F.lit(run).alias("run_id"), "body_slug", file_row, size)
        for run, rows in (("first", texts), ("second", texts.join(again, "doc_id")))
    ]
    newest = texts.where("lang <> 'fr'").join(again.withColumn("_again", F.lit(True)), "doc_id", "left")
    records = newest.select(F.when(F.col("_again"), "second").otherwise("first").alias("file_run"), file_row)
    return reclaim.reclaimable(reclaim.mark(stored[0].unionByName(stored[1]), reclaim.pointers(records)))


@query(
    SITE_SQL
    + """, k AS (
        SELECT replace(lower(body), ' ', '-') || '/' || partition_date || '/' || upper(lang) || '.'
            || coalesce(doc_type, 'html') AS clean_key,
            CASE WHEN cards.url LIKE 'https:%' THEN upper(lang)
                ELSE upper(lang[1]) || ' ' || upper(lang[2]) END AS identifier
        FROM cards JOIN site USING (page_id)
    )
    SELECT clean_key, count(DISTINCT identifier) AS identifiers FROM k
    GROUP BY clean_key HAVING count(DISTINCT identifier) > 1"""
)
def audit_key_collisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages as identifiers, written 'EN' or 'E N': the same key either way."""
    lang = F.upper(F.regexp_extract("url", "/([a-z][a-z])/", 1))
    spaced = F.concat(F.substr(lang, F.lit(1), F.lit(1)), F.lit(" "), F.substr(lang, F.lit(2)))
    rows = site.records(load(spark, sf_dir, "pages"))
    secure = F.col("url").startswith("https:")
    return audit.key_collisions(rows.withColumn("identifier", F.when(secure, lang).otherwise(spaced)))


@query(
    SITE_SQL
    + """SELECT count(*) AS records, count(*) FILTER (WHERE padded) AS relative_links,
        count(*) FILTER (WHERE unlinked) AS missing_links,
        count(*) FILTER (WHERE month(partition_date) = 3) AS bad_partitions
        FROM cards JOIN site USING (page_id)"""
)
def audit_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of all records (some cut down to their path) and two expected windows."""
    rows = site.records(load(spark, sf_dir, "pages"))
    link = F.when(site.padded(), F.regexp_replace("doc_url", "^https?://[^/]+", "")).otherwise(F.col("doc_url"))
    return audit.links(rows.withColumn("doc_url", link), [date(2024, 1, 1), date(2024, 2, 1)])


_RUN_SQL = (
    SITE_SQL
    + f""", firsts AS (
        SELECT *, body_order || '-' || partition_date || '-' || page || '-' || position AS file_row,
            replace(lower(body), ' ', '-') AS slug, CASE WHEN shell THEN 'pdf' ELSE 'html' END AS kind
        FROM cards WHERE identifier <> ''
        QUALIFY row_number() OVER (PARTITION BY identifier ORDER BY body_order, partition_date, page, position) = 1
    ), stored AS (
        SELECT *, CASE WHEN shell THEN 'r1.attached' ELSE 'r1' END AS run FROM firsts WHERE doc_url IS NOT NULL AND NOT lost
    ), zones AS (
        SELECT 'landing' AS zone, identifier, slug || '/' || partition_date || '/' || identifier || '.' || kind AS file_path,
            html AS content, kind, run AS file_run, file_row FROM stored
        UNION ALL
        SELECT 'clean', identifier, slug || '/' || partition_date || '/' || replace(identifier, ' ', '') || '.' || kind,
            CASE kind WHEN 'html' THEN {_CLEAN_SQL.format('html')} ELSE html END, kind, 'r1', run || '/' || file_row FROM stored
    )
    SELECT zone, identifier, file_path, sha256(content) AS file_hash, strlen(content)::bigint AS size,
        CASE kind WHEN 'pdf' THEN 'application/pdf' ELSE 'text/html' END AS content_type, file_run, file_row FROM zones"""
)


@query(_RUN_SQL)
def zone_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both stages run over the site into two new zones, and the files that their records lead to read back."""
    folder = f"{shared_folder(spark)}/zones-{uuid.uuid4().hex}"
    pages = load(spark, sf_dir, "pages")
    searches = site.searches(pages).select(*FETCHES.fieldNames())
    site.fetches(pages).unionByName(searches).write.parquet(f"{folder}/fetches")
    where = {"landing": (f"{folder}/landing", LANDING_METADATA), "clean": (f"{folder}/clean", CLEAN_METADATA)}
    zones.run_zones(
        spark, read_fetches(spark, f"{folder}/fetches"), where["landing"][0], where["clean"][0], site.BASE_URL,
        str(site.START), str(site.END), "r1", datetime(2024, 6, 1),
    )
    live = [
        tables.live_files(tables.read_files(spark, zone), cells.read(spark, zone, schema)).select(
            F.lit(name).alias("zone"), "identifier", "file_path", keys.file_hash("content").alias("file_hash"), "size",
            "content_type", F.col("run_id").alias("file_run"), "file_row",
        )
        for name, (zone, schema) in where.items()
    ]
    # Records without an identifier share one row of metadata, which is not for SQL.
    return live[0].unionByName(live[1]).where(F.col("identifier") != "")
