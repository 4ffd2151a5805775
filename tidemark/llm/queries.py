"""One query per operator over the given tables, with production parameters, and the SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import alignment, automata, bpe, chat, descent, infill, maxent, minhash, packing, quality_rules, suffixes, url_filter, voting

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            SQL[function.__name__] = sql
        return function

    return register


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


@query()
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


#: One more conversation, whose texts hold what marks turns.
_MARKED = "### Assistant: </turn> ok"


@query(
    """
    WITH turns AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL SELECT -7, 0, 'user', chr(92) || '### Assistant: </turn> ok'
        UNION ALL SELECT -7, 1, 'assistant', chr(92) || '### Assistant: </turn> ok'
    )
    SELECT conv_id, count(*) AS n_turns,
        sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
        CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
        sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
        CAST(sum(14 + length(regexp_replace(role, '[\\\\#<:]', '12', 'g'))
            + length(regexp_replace(text, '[\\\\#<]', '12', 'g'))) AS BIGINT) AS formatted_chars
    FROM turns GROUP BY conv_id
    """
)
def op4_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = load(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "\\" + _MARKED
    own = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    return chat.digests(chat.format_conversations(turns.unionByName(own)))


@query()
def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(load(spark, sf_dir, "documents"), ids=False)


@query()
def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.codec_rows(load(spark, sf_dir, "documents"))


_WORDS = r"list_filter(regexp_split_to_array({text}, '[\x20\x09-\x0D]+'), lambda w: w <> '')"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query(
    f"""
    WITH RECURSIVE worded AS (SELECT doc_id, {_WORDS.format(text=_LOWER)} AS w FROM documents),
    shingled AS (
        SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
            ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END)) AS s FROM worded
    ),
    sizes AS (SELECT doc_id, count(*) AS n FROM shingled GROUP BY doc_id),
    common AS (
        SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n FROM shingled x JOIN shingled y ON x.s = y.s
        WHERE x.doc_id <> y.doc_id GROUP BY x.doc_id, y.doc_id
    ),
    links AS (
        SELECT a, b FROM common c JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
        WHERE 100 * c.n >= 85 * (x.n + y.n - c.n)
    ),
    reach AS (
        SELECT doc_id, doc_id AS other FROM documents
        UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other
    ),
    low AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
    SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
    FROM documents d LEFT JOIN sizes USING (doc_id) JOIN low USING (doc_id)
    """
)
def op8_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(load(spark, sf_dir, "documents"))


@query(
    """
    WITH RECURSIVE v AS (
        SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE embedding IS NOT NULL
            AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
            AND len(list_filter(embedding, lambda c: c <> 0)) > 0
    ),
    links AS (
        SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y
            ON x.vec_id <> y.vec_id AND list_cosine_similarity(x.e, y.e) >= 0.9
    ),
    reach AS (
        SELECT vec_id, vec_id AS other FROM embeddings UNION SELECT r.vec_id, l.b FROM reach r JOIN links l ON l.a = r.other
    ),
    low AS (SELECT vec_id, min(other) AS component_id FROM reach GROUP BY vec_id),
    n AS (SELECT a, count(*) AS n FROM links GROUP BY a)
    SELECT e.vec_id, coalesce(n.n, 0) AS n_links, component_id, e.vec_id = component_id AS kept
    FROM embeddings e JOIN low USING (vec_id) LEFT JOIN n ON n.a = e.vec_id
    """
)
def op5_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return descent.near_duplicates(load(spark, sf_dir, "embeddings"))


@query()
def op2_maxent_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxent.score(load(spark, sf_dir, "documents"))


@query()
def op3_nearest_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return voting.classify(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


@query()
def op6_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.remove_repeats(load(spark, sf_dir, "documents"))


@query(
    f"""
    WITH worded AS (SELECT doc_id, {_WORDS.format(text="coalesce(text, '')")} AS w FROM documents),
    windows AS (
        SELECT doc_id, i, array_to_string(w[i:i + 34], ' ') AS s
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM worded)
    ),
    often AS (SELECT s FROM windows GROUP BY s HAVING count(*) > 1),
    starts AS (SELECT doc_id, list(i) AS spots FROM windows SEMI JOIN often USING (s) GROUP BY doc_id),
    gone AS (
        SELECT doc_id, list_distinct(flatten(list_transform(spots, lambda i: range(i, i + 35)))) AS spots FROM starts
    ),
    words AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS word FROM worded),
    lost AS (SELECT doc_id, unnest(spots) AS i FROM gone),
    kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text FROM words ANTI JOIN lost USING (doc_id, i) GROUP BY doc_id)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(gone.spots), 0) AS BIGINT) AS n_removed,
        sha256(coalesce(kept.text, '')) AS kept_sha256
    FROM worded LEFT JOIN gone USING (doc_id) LEFT JOIN kept USING (doc_id)
    """
)
def op7_suffix_automata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return automata.remove_repeats(load(spark, sf_dir, "documents"))


_URL_PATTERN = "(?s)^.*?://([^/?#]*)([^?#]*)"


def _gram_sql(text: str, n: int, salt: int) -> str:
    number = "c[i]"
    for k in range(1, n):
        number = f"({number} * {url_filter.BASE} + c[i + {k}])"
    letters = f"list_transform(regexp_extract_all({text}, '(?s).'), lambda l: unicode(l)::BIGINT)"
    return f"""(SELECT list_transform(range(1, len(c) - {n - 2}), lambda i: ({number} * 16 + {salt}) % {url_filter.BUCKETS})
        FROM (SELECT {letters} AS c))"""


_GRAMS_SQL = "list_concat({})".format(
    ", ".join(
        _gram_sql(text, n, 8 * s + n) for s, text in enumerate(("'^' || host || '$'", "path")) for n in url_filter.GRAMS
    )
)
_LABELLED_SQL = ", ".join(
    f"('{url}', {unwanted})" for table, unwanted in ((url_filter.UNWANTED, 1), (url_filter.WANTED, 0)) for url in table.split()
)
_HOST_SQL = f"""translate(coalesce(regexp_extract(url, '{_URL_PATTERN}', 1), ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, coalesce(regexp_extract(url, '{_URL_PATTERN}', 2), '') AS path"""
_RULED_SQL = " ".join(
    f"WHEN (host = '{r[: r.index('/')]}' OR ends_with(host, '.{r[: r.index('/')]}')) AND starts_with(path, '{r[r.index('/') :]}') THEN '{{}}'"
    for r, _ in sorted(url_filter.RULES, key=lambda r: -len(r[0]))
)
_VERDICTS = [v for _, v in sorted(url_filter.RULES, key=lambda r: -len(r[0]))]
_NAMES = [r for r, _ in sorted(url_filter.RULES, key=lambda r: -len(r[0]))]


@query(
    f"""
    WITH RECURSIVE labelled(url, y) AS (VALUES {_LABELLED_SQL}),
    told AS (
        SELECT e, y, {_GRAMS_SQL} AS grams FROM (SELECT row_number() OVER () AS e, y, {_HOST_SQL} FROM labelled)
    ),
    features AS (
        SELECT e, y, unnest(grams) AS b, 1 / sqrt(len(grams)) AS v FROM told
        UNION ALL SELECT e, y, {url_filter.BUCKETS}, 1.0 FROM told
    ),
    steps(k, b, w) AS (
        SELECT 0, range, 0.0::DOUBLE FROM range({url_filter.BUCKETS} + 1)
        UNION ALL
        SELECT k + 1, s.b, w * (1 - {url_filter.RATE * url_filter.PULL})
            + coalesce(pull, 0) * {url_filter.RATE} / (SELECT count(*) FROM labelled)
        FROM steps s LEFT JOIN (
            SELECT f.b, sum(missed * v) AS pull FROM features f JOIN (
                SELECT e, any_value(y) - 1 / (1 + exp(-sum(v * w))) AS missed FROM features JOIN steps USING (b) GROUP BY e
            ) USING (e) GROUP BY f.b
        ) g ON g.b = s.b WHERE k < {url_filter.STEPS}
    ),
    weights AS (SELECT list(w ORDER BY b) AS w FROM steps WHERE k = {url_filter.STEPS}),
    parsed AS (SELECT page_id, {_HOST_SQL} FROM pages),
    scored AS (
        SELECT page_id, host, path, {_GRAMS_SQL} AS grams, CASE {_RULED_SQL.format(*_NAMES)} END AS rule,
            CASE {_RULED_SQL.format(*_VERDICTS)} END AS ruled
        FROM parsed
    )
    SELECT page_id, host, path, rule, coalesce(ruled, CASE WHEN w[{url_filter.BUCKETS} + 1] + CASE WHEN len(grams) > 0
        THEN list_sum(list_transform(grams, lambda b: w[b + 1])) / sqrt(len(grams)) ELSE 0 END > 0 THEN 'block' ELSE 'allow' END) AS verdict
    FROM scored, weights
    """
)
def op13_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(load(spark, sf_dir, "pages")).drop("score")


@query()
def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return infill.transform(load(spark, sf_dir, "documents"))


@query()
def op11_pair_bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(load(spark, sf_dir, "documents"))
