"""One query per operator over its whole table, with the SQL that must give the same rows where SQL can."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from locusframe.llm import (
    alignment,
    decontamination,
    fillmiddle,
    graphsearch,
    kdtree,
    ngramjoin,
    packing,
    quality,
    sharding,
    suffixarray,
    tokencount,
    toxicity,
    urlrules,
)
from locusframe.llm.common import held_out, table

QUERIES = {}
ORACLES: dict[str, str] = {}

SHARDS = 24
SITE_RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))


def query(function):
    QUERIES[function.__name__] = function
    return function


def _judged(scored: DataFrame, threshold: float) -> DataFrame:
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )


@query
def op1_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    documents, labels = table(spark, sf, "documents").select("doc_id", "text"), table(spark, sf, "labels")
    return _judged(toxicity.score_toxicity(documents, documents, labels), 0.5)


@query
def op7_quality(spark: SparkSession, sf: str) -> DataFrame:
    documents, labels = table(spark, sf, "documents").select("doc_id", "text"), table(spark, sf, "labels")
    return _judged(quality.score_quality(documents, documents, labels, threshold=0.3), 0.3)


@query
def op2_interleave(spark: SparkSession, sf: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    rows = table(spark, sf, "documents").select(
        "doc_id",
        "source",
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    return sharding.interleave(rows, SHARDS, key=("doc_id", "text_crc32", "size")).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "source",
    )


@query
def op3_graph_search(spark: SparkSession, sf: str) -> DataFrame:
    return graphsearch.nearest(table(spark, sf, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


@query
def op4_ngram_join(spark: SparkSession, sf: str) -> DataFrame:
    return ngramjoin.near_duplicates(table(spark, sf, "documents"), n=4, percent=85)


@query
def op5_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    documents = table(spark, sf, "documents").select("doc_id", "text")
    matched = decontamination.find_matches(documents, table(spark, sf, "benchmark"))
    return matched.select("doc_id", F.inline("matches"))


@query
def op6_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack(table(spark, sf, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op8_suffix_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return suffixarray.removal_digest(table(spark, sf, "documents"), 200)


@query
def op9_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    documents = table(spark, sf, "documents").select("doc_id", "text")
    counted = tokencount.token_counts(documents, public_tokenizers.path("byte_bpe_50k.json"))
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 1024).alias("over_limit"))


@query
def op10_url_rules(spark: SparkSession, sf: str) -> DataFrame:
    pages = table(spark, sf, "pages").select("page_id", "url")
    return urlrules.judge(pages, SITE_RULES, urlrules.DEFAULT_RULES).drop("url")


@query
def op11_alignment(spark: SparkSession, sf: str) -> DataFrame:
    a, b = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return alignment.alignment_scores(table(spark, sf, "documents"), a, b)


@query
def op12_exact_search(spark: SparkSession, sf: str) -> DataFrame:
    return kdtree.top_products(table(spark, sf, "embeddings"), F.col("vec_id") % 20 == 0, k=20, factor=64)


@query
def op13_fill_in_middle(spark: SparkSession, sf: str) -> DataFrame:
    documents = table(spark, sf, "documents").select("doc_id", "text")
    rows = fillmiddle.restore(fillmiddle.fill_in_middle(documents, seed=42))
    digests = [F.sha2(c, 256).alias(f"{c}_sha256") for c in ("output", "restored")]
    return rows.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


def _url_sql() -> str:
    def matches(action: str) -> str:
        tests = [f"regexp_matches(lower(url), '{urlrules.regular(p)}')" for p, a in urlrules.DEFAULT_RULES if a == action]
        return " OR ".join(tests)

    rules = "\n".join(
        f"WHEN (host = '{r.split('/')[0]}' OR suffix(host, '.{r.split('/')[0]}')) AND starts_with(path, '/{r.split('/', 1)[1]}')"
        f" THEN '{r}'"
        for _, r in sorted(SITE_RULES, key=lambda x: (-len(x[1]), x[1]))
    )
    verdicts = " ".join(f"WHEN '{r}' THEN '{a}'" for a, r in SITE_RULES)
    return f"""
WITH cut AS (
  SELECT page_id, url, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
split AS (
  SELECT page_id, url,
         translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM cut),
ruled AS (SELECT *, CASE {rules} END AS rule FROM split)
SELECT page_id, host, path, rule,
       CASE rule {verdicts} ELSE CASE WHEN ({matches("block")}) AND NOT ({matches("allow")})
       THEN 'block' ELSE 'allow' END END AS verdict
FROM ruled"""


ORACLES["op10_url_rules"] = _url_sql()

ORACLES["op13_fill_in_middle"] = r"""
WITH units AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || doc_id) AS h,
         regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u
  FROM documents),
drawn AS (
  SELECT *, len(u) AS n, ('0x' || substr(h, 1, 8))::BIGINT % (len(u) + 1) AS c1, ('0x' || substr(h, 9, 8))::BIGINT % (len(u) + 1) AS c2,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                   OR ('0x' || substr(h, 17, 8))::BIGINT % 100 >= 50 THEN 'plain'
              WHEN ('0x' || substr(h, 25, 8))::BIGINT % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM units),
parts AS (
  SELECT *, array_to_string(u[1:least(c1, c2)], '') AS p, array_to_string(u[least(c1, c2) + 1:greatest(c1, c2)], '') AS m,
         array_to_string(u[greatest(c1, c2) + 1:], '') AS s
  FROM drawn)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
              ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts"""

# Integer products are exact in any order of addition.
ORACLES["op12_exact_search"] = """
WITH v AS (
  SELECT vec_id, [floor(64 * x::DOUBLE) FOR x IN embedding] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank, vec_id, score
FROM scored QUALIFY rank <= 20"""
