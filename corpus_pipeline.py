"""From raw documents to token files: quality, near duplicates, decontamination, mixing, encoding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from digestry.llm.catalog import prepare, table, tokenizer_path
from digestry.llm.decontaminate import drop_contaminated
from digestry.llm.mixing import write_mix
from digestry.llm.near_dups import NearSets, is_first, with_set_key
from digestry.llm.quality import quality_scores
from digestry.llm.token_files import token_digest
from digestry.session import scratch_path, stage


def without(docs: DataFrame, bad: DataFrame) -> DataFrame:
    """`docs` without the doc_ids of `bad` (column gone), which is written first, so that the planner joins by its real size."""
    bad = stage(bad, "gone")
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["gone"]), "left_anti")


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject. A doc_id with several rows goes if all of them are rejected."""
    scores = quality_scores(docs, table(prepare(spark), sf_dir, "labels"))
    best = scores.groupBy(F.col("doc_id").alias("gone")).agg(F.max("predicted").alias("best"))
    return without(docs, best.where("best = 0").select("gone"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: the one with the smallest doc_id, once even if its row is repeated.

    Rows without doc_id stay if they are empty, give way to a group that has an
    id, and otherwise leave one of their group: one row of its smallest set key.
    """
    prepare(spark)
    placed = stage(NearSets(docs).placed(), "classes")
    classes = placed.where("doc_id IS NOT NULL").withColumn("kept", is_first()).groupBy(F.col("doc_id").alias("gone")).agg(F.max("kept").alias("kept"), F.count("*").alias("n"))
    left = without(docs.where("doc_id IS NOT NULL"), classes.where("NOT kept").select("gone"))
    repeated = stage(classes.where("kept AND n > 1").select("gone"), "repeated")
    if repeated.limit(1).count():
        again = left.join(repeated, left["doc_id"].eqNullSafe(repeated["gone"]), "left_semi").dropDuplicates(["doc_id", "text"])
        left = without(left, repeated).unionByName(again)
    if not placed.where("doc_id IS NULL").limit(1).count():
        return left
    nameless = with_set_key(docs.where("doc_id IS NULL"), "_key")
    chosen = placed.where("n > 0 AND component_id IS NULL").groupBy("root").agg(F.min("key").alias("_key")).select("_key")
    whole = F.struct(*docs.columns)
    alone = nameless.join(chosen, "_key", "left_semi").groupBy("_key").agg(F.min_by(whole, F.xxhash64(*docs.columns)).alias("_row")).select("_row.*")
    return left.unionByName(nameless.where("_key IS NULL").drop("_key")).unionByName(alone)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return drop_contaminated(docs, table(prepare(spark), sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    prepare(spark)
    return write_mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix, read back: one row for each document and pass."""
    prepare(spark)
    return token_digest(docs, tokenizer_path())


STAGES = [
    ("quality classifier", keep_quality),
    ("near duplicates", drop_near_duplicates),
    ("decontamination", decontaminate),
    ("mixing", mix_sources),
    ("token files", encode),
]

# The classifier, the hash functions and the tokenizer are outside SQL; tests compare the stages with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; each is written as Parquet and read again, so a lost executor repeats tasks of one stage only."""
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES:
        path = scratch_path(spark, f"pipeline-{name.replace(' ', '-')}")
        function(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
