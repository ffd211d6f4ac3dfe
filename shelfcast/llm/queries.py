"""The registered queries of this package and the SQL they must agree with, where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.llm import (
    codes,
    cover,
    decontaminate,
    html_text,
    language,
    lexical,
    neighbours,
    packing,
    quality,
    simhash,
    token_output,
    tokens,
    url_filter,
)
from shelfcast.llm.common import fold, table
from shelfcast.llm.url_filter import Rule

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def keep(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return keep


@query("op1_token_counts")
def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every whole document."""
    return tokens.count_tokens(table(spark, sf_dir, "documents"), max_tokens=1024)


@query("op4_token_binary_output")
def token_binary_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed id matrix of all documents, with a checksum in place of the ids."""
    return token_output.digest(token_output.write_packed_ids(table(spark, sf_dir, "documents"), capacity=2048))


@query("op6_simhash_near_dedup")
def simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate component of every document."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle_words=3, max_bits=2)


@query("op8_best_fit_packing")
def best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place of every piece of every document in sequences of at most 2048 tokens."""
    return packing.pack_documents(table(spark, sf_dir, "documents"), capacity=2048, end_id=0)


@query("op2_benchmark_decontamination")
def benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that overlap with benchmark items, with the overlap."""
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op3_html_extraction")
def html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_text.extract(table(spark, sf_dir, "pages"))


@query("op5_nearest_neighbours")
def nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest vectors of every fiftieth one."""
    return neighbours.nearest_neighbours(table(spark, sf_dir, "embeddings"), query_every=50, nearest=5)


@query("op7_quality_classifier")
def quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document; labels of one fold in five are never learnt from."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(fold("doc_id", 5) != 0).select("doc_id", "quality")
    field = quality.fit(documents, labels)
    return quality.score(documents, field).select(
        "doc_id",
        (fold("doc_id", 5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


@query("op10_language_id")
def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; one fold in four is never learnt from."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    network = language.fit(documents.where(fold("doc_id", 4) != 2))
    return language.predict(documents.select("doc_id", "text"), network).select(
        "doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score"
    )


RULES = [
    Rule("allow", "com", "/"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
]

URL_SQL = """
WITH rules(verdict, host, path) AS (VALUES
    ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
    ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
cut AS (
    SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
    FROM pages),
parts AS (
    SELECT page_id,
        translate(regexp_extract(rest, '^([^/?#]*)', 1),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
    FROM (SELECT page_id, coalesce(rest, '') AS rest FROM cut)),
fitting AS (
    SELECT p.page_id, p.host, p.path, r.host || r.path AS rule, r.verdict,
        row_number() OVER (PARTITION BY p.page_id ORDER BY length(r.host || r.path) DESC, length(r.host) DESC) AS n
    FROM parts p LEFT JOIN rules r
        ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM fitting WHERE n = 1
"""


@query("op9_url_filters", URL_SQL)
def url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict of the url rules on every page."""
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), RULES)


def _codes_sql(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """Lloyd rounds unrolled: one assignment and one update per round, over components as rows."""
    steps = [
        f"""kept AS (
    SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(embedding) > 0
      AND list_aggregate(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)), 'bool_and')),
width AS (SELECT len(v) AS w FROM kept ORDER BY vec_id NULLS LAST, v LIMIT 1),
comps AS (
    SELECT vec_id, label, (i - 1) * {parts} // w AS pos, (i - 1) - ((i - 1) * {parts} // w) * (w // {parts}) AS j, v[i] AS val
    FROM kept, width, range(1, w + 1) t(i) WHERE len(v) = w),
b0 AS (
    SELECT c.pos, f.entry, c.j, c.val FROM comps c JOIN (
        SELECT vec_id, row_number() OVER (ORDER BY vec_id NULLS LAST, v) - 1 AS entry
        FROM kept, width WHERE len(v) = w ORDER BY vec_id NULLS LAST, v LIMIT {entries}) f USING (vec_id))"""
    ]
    for r in range(1, rounds + 2):
        steps.append(
            f"""a{r} AS (
    SELECT vec_id, pos, entry, dist FROM (
        SELECT c.vec_id, c.pos, b.entry, sum((c.val - b.val) * (c.val - b.val)) AS dist
        FROM comps c JOIN b{r - 1} b ON c.pos = b.pos AND c.j = b.j GROUP BY c.vec_id, c.pos, b.entry)
    QUALIFY row_number() OVER (PARTITION BY vec_id, pos ORDER BY dist, entry) = 1)"""
        )
        if r <= rounds:
            steps.append(
                f"""m{r} AS (
    SELECT a.pos, a.entry, c.j, sum(c.val)::HUGEINT AS s, count(*) AS n
    FROM a{r} a JOIN comps c ON a.vec_id = c.vec_id AND a.pos = c.pos GROUP BY a.pos, a.entry, c.j),
b{r} AS (
    SELECT b.pos, b.entry, b.j,
        coalesce(CAST((m.s - ((m.s % m.n) + m.n) % m.n) // m.n AS BIGINT), b.val) AS val
    FROM b{r - 1} b LEFT JOIN m{r} m ON b.pos = m.pos AND b.entry = m.entry AND b.j = m.j)"""
            )
    last = rounds + 1
    steps.append(
        f"""coded AS (
    SELECT vec_id, string_agg(printf('%02x', entry), '' ORDER BY pos) AS code, sum(dist)::BIGINT AS error
    FROM a{last} GROUP BY vec_id),
labelled AS (SELECT c.*, k.label FROM coded c JOIN kept k USING (vec_id))"""
    )
    return (
        "WITH "
        + ",\n".join(steps)
        + f"""
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
    (SELECT sha256(coalesce(string_agg(CAST(val AS VARCHAR), ',' ORDER BY pos, entry, j), '')) FROM b{rounds}) AS codebooks_sha256
FROM labelled
"""
    )


@query("op11_vector_codes", _codes_sql())
def vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product codes of every whole vector: 8 parts, 16 entries a part, 6 Lloyd rounds."""
    return codes.compress(table(spark, sf_dir, "embeddings"), parts=8, entries=16, rounds=6)


_TERMS = r"regexp_extract_all(translate(coalesce({0}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

SEARCH_SQL = f"""
WITH d AS (SELECT doc_id, {_TERMS.format("text")} AS t FROM documents),
stats AS (SELECT count(*) FILTER (WHERE len(t) > 0) AS nd, coalesce(sum(len(t)), 0) AS nt FROM d),
tf AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(t) AS term FROM d) GROUP BY ALL),
q AS (SELECT item_id, unnest(t) AS term FROM (SELECT DISTINCT item_id, {_TERMS.format("text")} AS t FROM benchmark)),
df AS (SELECT term, count(*) AS df FROM tf WHERE term IN (SELECT term FROM q) GROUP BY term),
w AS (SELECT term, CAST(floor(1000 * ln((2.0 * nd + 2) / (2.0 * df + 1))) AS BIGINT) AS w FROM df, stats),
imp AS (
    SELECT tf.doc_id, tf.term,
        w.w * ((1000000000 * tf.tf) // (1000 * tf.tf + 12 * (75 + (25 * len(d.t) * nd) // nt))) AS imp
    FROM tf JOIN w USING (term) JOIN d USING (doc_id), stats),
s AS (SELECT q.item_id, imp.doc_id, CAST(sum(imp.imp) AS BIGINT) AS score FROM q JOIN imp USING (term) GROUP BY ALL)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INT) AS rank, doc_id, score
FROM s WHERE score > 0 QUALIFY rank <= 20
"""


@query("op12_lexical_search", SEARCH_SQL)
def lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best documents of every benchmark item, over all documents."""
    return lexical.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=20)


@query("op13_embedding_near_dedup")
def embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate component of every vector: cosine 0.98 or more within a label."""
    return cover.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.98)
