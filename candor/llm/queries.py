"""The queries of this subpackage by name, each over its whole table, and SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candor.llm import (alignment, compress_lang, html_text, maxscore, mixing, periodic_runs, pieces, recompression,
                        sharding, simhash, syncmers, token_counts, url_filter)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_main_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.page_texts(table(spark, sf_dir, "pages"))


@query
def op2_url_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.url_verdicts(table(spark, sf_dir, "pages"))


@query
def op3_simhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op4_balanced_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.balanced_shards(table(spark, sf_dir, "documents"))


@query
def op5_source_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weights and probabilities to six digits, for comparison."""
    mixed = mixing.mixture(table(spark, sf_dir, "documents"))
    return mixed.withColumns({c: F.round(c, 6) for c in ("weight", "probability")})


@query
def op6_sampled_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encoded and decoded again: counts and digests of the pieces, and whether the text came back whole."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    back = pieces.encode(docs, decoded="decoded")
    return back.select(
        "doc_id", F.length("text").cast("long").alias("n_chars"), F.size("pieces").cast("long").alias("n_pieces"),
        F.xxhash64("pieces").alias("pieces_hash"), F.sha2("decoded", 256).alias("decoded_sha256"),
        F.col("decoded").eqNullSafe(F.col("text")).alias("lossless"))


@query
def op7_syncmer_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syncmers.edit_matches(table(spark, sf_dir, "documents"))


@query
def op8_top_inner_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = maxscore.integer_vectors(table(spark, sf_dir, "embeddings"))
    return maxscore.top_k(vectors, F.col("vec_id") % maxscore.QUERY_STEP == 0)


@query
def op9_languages_by_compression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compress_lang.languages(table(spark, sf_dir, "documents"))


@query
def op10_edit_aware_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four edits on every document, and its token counts before and after them."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    counted = token_counts.edited_counts(docs.withColumn("edits", token_counts.standard_edits(docs.text, docs.doc_id)))
    return counted.select(
        "doc_id", F.length("text").cast("long").alias("n_chars"), "n_tokens", "n_pretokens", "edited_tokens",
        "reencoded_chars", F.sha2("edited", 256).alias("edited_sha256"))


@query
def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.link_statistics(table(spark, sf_dir, "documents"))


def _with_planted_runs(docs: DataFrame) -> DataFrame:
    """``doc_id, text``: of every tenth document or so, by a hash of its id, the words from some place on repeat themselves."""
    bare = F.btrim(F.coalesce("text", F.lit("")), F.lit(" \t\n\x0b\f\r"))
    rows = docs.select("doc_id", "text", F.crc32(F.col("doc_id").cast("string").cast("binary")).alias("h"))
    rows = rows.withColumn("w", F.when((F.col("h") % 10 == 0) & (bare != ""), F.split(bare, r"[\x20\x09-\x0D]+")))
    rows = rows.withColumns({"n": F.size("w").cast("long"), "g": F.floor(F.col("h") / 10)}).withColumn("a", F.expr("g % n"))
    rows = rows.withColumn("p", F.expr("1 + (n - a) DIV (3 + g % 8)"))
    # The period, as often as it fits; no lambda, in which the optimiser would split the text once a word.
    again = F.expr("""array_join(concat(slice(w, 1, int(a)), slice(flatten(array_repeat(
        slice(w, int(a + 1), int(p)), int((n - a + p - 1) DIV p))), 1, int(n - a))), ' ')""")
    return rows.select("doc_id", F.when(F.col("w").isNotNull(), again).otherwise(F.col("text")).alias("text"))


@query
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The longest run of each document, and digests of all its runs and of the text without their repetitions."""
    found = periodic_runs.collapsed(_with_planted_runs(table(spark, sf_dir, "documents")))
    top = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"])))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    found = found.withColumn("top", top)
    length, period = F.col("top.length"), -F.col("top.col3")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("top.col2")).alias("start"), length.alias("length"),
        period.alias("period"), F.expr("(1000 * top.length) DIV (-top.col3)").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))


@query
def op13_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = recompression.repeats_removed(table(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def _sql_list(values) -> str:
    return ", ".join("(" + ", ".join(f"'{x}'" for x in v) + ")" for v in values)


def _url_sql() -> str:
    rules = [(r, verdict, r.partition("/")[0], "/" + r.partition("/")[2])
             for verdict, named in url_filter.RULES.items() for r in named]
    return f"""
WITH rules(rule, verdict, h, p) AS (VALUES {_sql_list(rules)}),
hosts(h) AS (VALUES {_sql_list((h,) for h in url_filter.LISTED_HOSTS)}),
urls AS (
  SELECT page_id,
         coalesce(translate(regexp_extract(url, '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
fits AS (
  SELECT page_id, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
  FROM urls JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY page_id),
bad AS (SELECT DISTINCT page_id FROM urls JOIN hosts ON host = h OR ends_with(host, '.' || h))
SELECT urls.page_id, host, path, rule, bad.page_id IS NOT NULL AS listed,
       coalesce(verdict, CASE WHEN bad.page_id IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict
FROM urls LEFT JOIN fits USING (page_id) LEFT JOIN bad USING (page_id)"""


def _search_sql() -> str:
    return f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor({maxscore.SCALE} * x::DOUBLE)) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND NOT coalesce(list_bool_or(list_transform(embedding, lambda x: x IS NULL OR NOT isfinite(x))), false)),
pairs AS (
  SELECT q.r, q.vec_id AS query_id, d.vec_id, CAST(list_inner_product(q.v, d.v) AS BIGINT) AS score
  FROM v q JOIN v d ON q.vec_id % {maxscore.QUERY_STEP} = 0 AND q.r <> d.r),
ranked AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS rank FROM pairs)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= {maxscore.TOP}"""


def _mixture_sql(cycles: int = 30) -> str:
    """Raking written out for a number of cycles that is ample for the tolerance of the operator."""
    topics = " ".join(f"WHEN regexp_matches(coalesce(text, ''), '{p}') THEN '={name}'" for name, p in mixing.TOPICS)
    parts = [f"""
WITH own AS MATERIALIZED (
  SELECT doc_id, coalesce('=' || source, '-') AS source, coalesce('=' || lang, '-') AS lang,
         CASE {topics} ELSE '=prose' END AS topic,
         CAST(len(regexp_extract_all(coalesce(text, ''), '{mixing.WORD}')) AS BIGINT) AS tokens
  FROM documents),
cells AS MATERIALIZED (SELECT source, lang, topic, CAST(sum(tokens) AS DOUBLE) AS t FROM own WHERE tokens > 0 GROUP BY ALL)"""]
    parts.append(f"""
raised AS MATERIALIZED (SELECT *, pow(t, {mixing.TEMPERATURE}) AS r FROM cells)""")
    for m in mixing.MARGINS:
        parts.append(f"""
want_{m} AS MATERIALIZED (
  SELECT {m}, sum(r) / (SELECT sum(r) FROM raised) * (SELECT sum(t) FROM cells) AS want FROM raised GROUP BY {m}),
{m}_0 AS MATERIALIZED (SELECT {m}, 1.0::DOUBLE AS f FROM want_{m})""")
    at = dict.fromkeys(mixing.MARGINS, 0)
    for _ in range(cycles):
        for m in mixing.MARGINS:
            a, b = (x for x in mixing.MARGINS if x != m)
            parts.append(f"""
{m}_{at[m] + 1} AS MATERIALIZED (
  SELECT {m}, any_value(want) / sum(t * a.f * b.f) AS f
  FROM cells JOIN {a}_{at[a]} a USING ({a}) JOIN {b}_{at[b]} b USING ({b}) JOIN want_{m} USING ({m}) GROUP BY {m})""")
            at[m] += 1
    s, l, t = (f"{m}_{at[m]}" for m in mixing.MARGINS)
    parts.append(f"""
raked AS MATERIALIZED (
  SELECT source, lang, topic, s.f * l.f * t.f AS w
  FROM cells JOIN {s} s USING (source) JOIN {l} l USING (lang) JOIN {t} t USING (topic)),
judged AS (
  SELECT own.*, CASE WHEN tokens = 0 THEN 1.0 ELSE w END AS weight,
         CASE WHEN tokens = 0 THEN 1.0 ELSE w / (SELECT max(w) FROM raked) END AS probability
  FROM own LEFT JOIN raked USING (source, lang, topic))
SELECT doc_id, source, lang, topic, tokens, round(weight, 6) AS weight, round(probability, 6) AS probability,
       CAST('0x' || substr(md5('{mixing.SEED}:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 13) AS BIGINT)
         / {float(1 << 52)} < probability AS kept
FROM judged""")
    return ",".join(parts)


def _passages_sql() -> str:
    """Every window by its words."""
    n = recompression.WINDOW
    return f"""
WITH own AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id,
         list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
windows AS MATERIALIZED (
  SELECT r, doc_id, unnest(range(1, len(w) - {n - 2})) AS x, unnest(list_transform(
    range(1, len(w) - {n - 2}), lambda x: md5(array_to_string(w[x:x + {n - 1}], ' ')))) AS k
  FROM own WHERE len(w) >= {n}),
least AS (SELECT k, min(doc_id) AS low FROM windows GROUP BY k),
gone AS (
  SELECT DISTINCT r, x + i AS place FROM windows JOIN least USING (k), unnest(range(0, {n})) AS t(i) WHERE low < doc_id),
words AS (SELECT r, unnest(range(1, len(w) + 1)) AS place, unnest(w) AS word FROM own),
left_over AS (
  SELECT r, string_agg(word, ' ' ORDER BY place) AS kept, count(*) AS n FROM words ANTI JOIN gone USING (r, place) GROUP BY r)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM own LEFT JOIN left_over USING (r)"""


ORACLES |= {
    "op13_repeated_passages": _passages_sql(),
    "op2_url_verdicts": _url_sql(),
    "op5_source_mixture": _mixture_sql(),
    "op8_top_inner_products": _search_sql(),
}
