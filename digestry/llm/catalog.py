"""Queries of this subpackage: (spark, sf_dir) -> DataFrame, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from digestry.llm import sql

# Texts go to Python in batches that fit beside each other in a worker.
ARROW_CONF = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000", "spark.sql.execution.arrow.maxBytesPerBatch": "4m"}

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}
TOKENIZER = "word_bpe_49k.json"
PIECE_MODEL = "piece_bpe_32k.model"


def query(function: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(prepare(spark), sf_dir)

    QUERIES[function.__name__] = run
    return run


def prepare(spark: SparkSession) -> SparkSession:
    for key, value in ARROW_CONF.items():
        spark.conf.set(key, value)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_credentials(spark: SparkSession, sf_dir: str) -> DataFrame:
    from digestry.llm.credentials import credential_digest

    return credential_digest(table(spark, sf_dir, "documents"))


@query
def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from digestry.llm.decontaminate import contamination

    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from digestry.llm.token_files import REMEMBERED_ALONE, token_digest

    return token_digest(table(spark, sf_dir, "documents"), tokenizer_path(), remembered=REMEMBERED_ALONE)


@query
def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from digestry.llm.mixing import mix

    return mix(table(spark, sf_dir, "documents"))


@query
def op5_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    from digestry.llm.ppm import lm_scores

    return lm_scores(table(spark, sf_dir, "documents"))


@query
def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from digestry.llm.near_dups import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"))


@query
def op7_spot_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from digestry.llm.spots import fingerprint_digest

    return fingerprint_digest(table(spark, sf_dir, "documents"))


@query
def op8_quote_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    from digestry.llm.quotes import chat_messages

    return chat_messages(table(spark, sf_dir, "conversations"))


@query
def op9_license_notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    from digestry.llm.licenses import license_digest

    return license_digest(table(spark, sf_dir, "documents"))


@query
def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from digestry.llm.quality import quality_scores

    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op11_piece_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    from digestry.llm.pieces import piece_digest

    return piece_digest(table(spark, sf_dir, "documents"), tokenizer_path(PIECE_MODEL))


@query
def op12_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    from digestry.llm.centroids import cluster_digest

    return cluster_digest(table(spark, sf_dir, "embeddings"))


@query
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from digestry.llm.manifest import manifest_digest

    return manifest_digest(table(spark, sf_dir, "documents"))


SQL["op2_decontamination"] = r"""
WITH item AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
win AS (
  SELECT DISTINCT item_id, w[s:s + 9] AS words
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM item WHERE len(w) > 0)),
doc AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
  FROM documents),
len AS (SELECT DISTINCT len(words) AS n FROM win),
place AS (SELECT r, n, unnest(range(1, len(w) - n + 2)) AS s, w FROM doc, len WHERE len(w) >= n),
met AS (SELECT place.r, place.s, place.n, win.item_id FROM place JOIN win ON win.words = place.w[place.s:place.s + place.n - 1]),
hit AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(s, s + n)) AS p FROM met) GROUP BY r),
ids AS (SELECT r, list(DISTINCT item_id::VARCHAR) AS l FROM met WHERE item_id IS NOT NULL GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(len(l), 0)::BIGINT AS n_items,
  sha256(coalesce(array_to_string(list_sort(l), ','), '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN hit USING (r) LEFT JOIN ids USING (r)
"""
SQL["op12_centroid_clusters"] = sql.clusters()
SQL["op13_merkle_manifest"] = sql.manifest()
