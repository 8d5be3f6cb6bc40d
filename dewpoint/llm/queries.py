"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dewpoint.llm.common import WORD, table
from dewpoint.llm.embeddings import near_embeddings
from dewpoint.llm.languages import held_out, identify, train
from dewpoint.llm.licences import scan_licences
from dewpoint.llm.minhash import near_duplicates
from dewpoint.llm.mixing import mix_sources
from dewpoint.llm.packing import pack_documents
from dewpoint.llm.phrases import collocations
from dewpoint.llm.runs import longest_run, periodic_runs
from dewpoint.llm.sharding import shard_documents
from dewpoint.llm.quality import score_quality
from dewpoint.llm.secrets import KINDS, scan_secrets, span_text
from dewpoint.llm.topk import quantised, top_k, usable
from dewpoint.llm.urls import UrlRule, judge_urls


def op1_near_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_embeddings(table(spark, sf_dir, "embeddings"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_sources(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


# The listed URL rules.
URL_RULES = [
    UrlRule("com", "/", "allow"),
    UrlRule("example.com", "/en/", "block"),
    UrlRule("www.example.com", "/en/", "allow"),
    UrlRule("net", "/es/", "block"),
    UrlRule("net", "/fr/", "block"),
]


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"), URL_RULES)


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).drop("text_key")


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return score_quality(docs, table(spark, sf_dir, "labels")).drop("text")


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = scan_secrets(docs).select("doc_id", "base", "spans")

    def number_of(kind: str) -> Column:
        place = KINDS.index(kind)
        return F.size(F.filter("base", lambda s: s["kind"] == place)).cast("long")

    return found.select(
        "doc_id",
        *[number_of(kind).alias(f"n_{kind}") for kind in ("assign", "access", "hex")],
        F.sha2(span_text(F.col("base")), 256).alias("base_sha256"),
        span_text(F.col("spans")).alias("spans"),
    )


def op9_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files ``source/lang/doc_id.txt``."""
    files = table(spark, sf_dir, "documents").select(
        "doc_id",
        F.concat(F.concat_ws("/", "source", "lang", F.col("doc_id").cast("string")), F.lit(".txt"))
        .alias("path"),
        "text",
    )
    return scan_licences(files)


def op10_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    embeddings = table(spark, sf_dir, "embeddings").filter(usable(F.col("embedding")))
    vectors = embeddings.select("vec_id", quantised(F.col("embedding")).alias("vector"))
    return top_k(vectors, vectors.filter(F.col("vec_id") % 50 == 0))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


def op12_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learns from the documents that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    apart = docs.withColumn("held_out", held_out("doc_id"))
    model = train(apart.filter(~F.col("held_out")))
    return identify(apart.select("doc_id", "text", "held_out"), model).drop("text")


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose crc32 ends in 0 go on periodically from some word."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = periodic_runs(docs.withColumn("text", _made_periodic()))
    line = F.transform(
        "runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    )
    length, period = longest_run(F.col("runs"), "length"), longest_run(F.col("runs"), "period")
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        longest_run(F.col("runs"), "start").alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.call_function("div", length * 1000, period).alias("exponent_milli"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def _made_periodic() -> Column:
    """The text; every tenth one's words from number a on repeat the first p of them."""
    text = F.coalesce("text", F.lit(""))
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    h = F.crc32(F.col("doc_id").cast("string"))
    g, n = F.floor(h / 10), F.size(words)
    a = F.try_mod(g, n).cast("int")
    p = F.floor((n - a) / (3 + g % 8)).cast("int") + 1
    times = F.ceil((n - a) / p).cast("int")
    cycle = F.slice(words, a + 1, p)
    rest = F.slice(F.flatten(F.array_repeat(cycle, times)), F.lit(1), n - a)
    repeated = F.concat(F.slice(words, F.lit(1), a), rest)
    return F.when((h % 10 == 0) & F.regexp_like(text, F.lit(WORD)), F.array_join(repeated, " ")).otherwise(text)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    named = (
        op1_near_embeddings,
        op2_packing,
        op3_mixing,
        op4_url_filter,
        op5_near_duplicates,
        op6_sharding,
        op7_quality,
        op8_secret_scan,
        op9_licence_scan,
        op10_top_k,
        op11_collocations,
        op12_language,
        op13_periodic_runs,
    )
    return {query.__name__: query for query in named}


# Words as in dewpoint.llm.common.WORD, and the 60-bit hash of text_hash.
MIXING_SQL = r"""
WITH rows_ AS (
  SELECT doc_id, source,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         CAST('0x' || substr(md5(coalesce('+' || CAST(doc_id AS VARCHAR), '-') || '|' ||
           coalesce('+' || text, '-')), 1, 15) AS BIGINT) AS h
  FROM documents),
by_source AS (SELECT source, CAST(sum(size) AS BIGINT) AS s FROM rows_ GROUP BY source),
weighed AS (
  SELECT *, [3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w
  FROM by_source),
ranked AS (
  SELECT *, sum(2 * s) OVER o AS limits, sum(w) OVER () - sum(w) OVER o AS open_,
         3 * sum(s) OVER () AS budget
  FROM weighed WINDOW o AS (ORDER BY s * (6 // w), source NULLS LAST
                            ROWS UNBOUNDED PRECEDING)),
filled AS (SELECT *, (limits * w + 2 * s * open_) * 2 <= budget * w AS full_ FROM ranked),
aimed AS (
  SELECT source, s, CASE WHEN full_ THEN CAST(2 * s AS DOUBLE) ELSE
    (CAST(budget AS DOUBLE) / 2 - CAST(sum(CASE WHEN full_ THEN 2 * s ELSE 0 END) OVER () AS DOUBLE))
      / CAST(sum(CASE WHEN full_ THEN 0 ELSE w END) OVER () AS DOUBLE) * CAST(w AS DOUBLE)
    END AS target
  FROM filled),
parted AS (
  SELECT *, coalesce(floor(target / nullif(CAST(s AS DOUBLE), 0)), 0) AS copies,
         target - coalesce(floor(target / nullif(CAST(s AS DOUBLE), 0)), 0) * s AS rest
  FROM aimed),
hashes AS (
  SELECT source, h, CAST(sum(size) AS BIGINT) AS words FROM rows_ GROUP BY source, h),
summed AS (
  SELECT source, h, words, coalesce(sum(words) OVER (PARTITION BY source ORDER BY h
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM hashes),
ends AS (
  SELECT p.source, max(e.h) AS threshold
  FROM summed e JOIN parted p ON p.source IS NOT DISTINCT FROM e.source
  WHERE e.before <= p.rest GROUP BY p.source),
edges AS (
  SELECT p.*, n.threshold, e.words <= (p.rest - e.before) * 2 AS at_threshold
  FROM parted p JOIN ends n ON n.source IS NOT DISTINCT FROM p.source
  JOIN summed e ON e.source IS NOT DISTINCT FROM p.source AND e.h = n.threshold)
SELECT r.doc_id, CAST(r.size AS BIGINT) AS size, e.s AS source_size, e.target,
       CAST(r.size * (e.copies + CASE WHEN r.h < e.threshold
         OR (r.h = e.threshold AND e.at_threshold) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM rows_ r JOIN edges e ON e.source IS NOT DISTINCT FROM r.source
"""

NEAR_EMBEDDINGS_SQL = """
WITH RECURSIVE units AS (
  SELECT vec_id, CASE WHEN len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
    AND len([x FOR x IN embedding IF x <> 0]) > 0
    THEN [CAST(x AS DOUBLE) FOR x IN embedding] END AS v FROM embeddings),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM units a JOIN units b
    ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.v, b.v) >= 0.9::DOUBLE
  WHERE a.v IS NOT NULL AND b.v IS NOT NULL),
reached AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings
  UNION SELECT r.a, l.b FROM reached r JOIN links l ON l.a = r.b)
SELECT e.vec_id, (SELECT count(*) FROM links l WHERE l.a = e.vec_id) AS n_links,
       min(r.b) AS component_id, e.vec_id = min(r.b) AS kept
FROM embeddings e JOIN reached r ON r.a = e.vec_id GROUP BY e.vec_id
"""

TOP_K_SQL = """
WITH vectors AS (
  SELECT vec_id, [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM vectors q JOIN vectors c ON c.vec_id IS DISTINCT FROM q.vec_id
  WHERE q.vec_id % 50 = 0),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id
    ORDER BY score DESC, vec_id NULLS LAST) AS INTEGER) AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""

COLLOCATIONS_SQL = r"""
WITH folded AS (
  SELECT coalesce(lang, 'und') AS lang,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents),
pieces AS (
  SELECT lang, regexp_extract_all(unnest(string_split_regex(text, '[.,;:!?\x0A-\x0D]')),
                                  '[^\x20\x09]+') AS words
  FROM folded),
sizes AS (SELECT lang, CAST(sum(len(words)) AS BIGINT) AS n FROM pieces GROUP BY lang),
runs AS (
  SELECT lang, k, words, unnest(generate_series(1, len(words) - k + 1)) AS i
  FROM pieces, (SELECT unnest([1, 2, 3, 4, 5]) AS k)),
counts AS (
  SELECT lang, k, array_to_string(words[i : i + k - 1], ' ') AS phrase, count(*) AS f
  FROM runs GROUP BY ALL HAVING count(*) >= 100),
cuts AS (
  SELECT lang, k, phrase, f AS a, unnest(generate_series(1, k - 1)) AS cut,
         string_split(phrase, ' ') AS words
  FROM counts WHERE k > 1),
scored AS (
  SELECT c.lang, c.k, c.phrase, c.a, l.f AS l, r.f AS r, s.n, c.cut,
         CAST(CAST(1000 AS HUGEINT) * c.a * s.n // (CAST(l.f AS HUGEINT) * r.f) AS BIGINT)
           AS score
  FROM cuts c JOIN sizes s USING (lang)
  JOIN counts l ON l.lang = c.lang AND l.phrase = array_to_string(words[:cut], ' ')
  JOIN counts r ON r.lang = c.lang AND r.phrase = array_to_string(words[cut + 1:], ' ')),
lowest AS (
  SELECT * FROM scored
  QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
whole AS (
  SELECT * FROM lowest s WHERE NOT EXISTS (
    SELECT 1 FROM counts o WHERE o.lang = s.lang AND o.k > s.k AND 100 * o.f >= 100 * s.a
      AND contains(' ' || o.phrase || ' ', ' ' || s.phrase || ' '))),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM whole)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_near_embeddings": NEAR_EMBEDDINGS_SQL,
        "op3_mixing": MIXING_SQL,
        "op10_top_k": TOP_K_SQL,
        "op11_collocations": COLLOCATIONS_SQL,
    }
