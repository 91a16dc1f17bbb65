"""Knowledge graph of the visible items."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from digestry.config import GROUPS
from digestry.operators import graph
from digestry.plans import roles
from digestry.plans.catalog import query
from digestry.plans.roles import NOW, SETTINGS, TAXONOMY, joined, stamp
from digestry.session import stage

FILTER_GROUPS = {"targets": ["harbour", "reader"], "tasks": ["choosing", "gathering"]}
TYPES = ("paper", "target", "method")
SEARCH = "the"


def visible(spark: SparkSession, sf_dir: str, relations: DataFrame) -> DataFrame:
    """The capped set of shown items; staged, since nodes, edges and weights all start from it."""
    counts = relations.groupBy("id").agg(F.count("*").alias("relations"))
    shown = graph.visible_items(
        roles.items(spark, sf_dir), counts, NOW, SETTINGS.graph_recent_days, SETTINGS.graph_max_nodes
    )
    columns = ("id", "kind", "title", "summary", "published_at", "visibility", *GROUPS)
    return stage(shown.select(*columns), "visible")


def built(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    relations = stage(roles.relations(spark, sf_dir), "relations")
    nodes, edges = graph.build_graph(visible(spark, sf_dir, relations), relations, TAXONOMY)
    edges = stage(edges, "edges")
    return stage(graph.with_weights(nodes.drop("weight"), edges), "nodes"), edges


@query
def graph_visible(spark: SparkSession, sf_dir: str) -> DataFrame:
    return visible(spark, sf_dir, roles.relations(spark, sf_dir)).select("id", "kind", F.round("visibility", 6).alias("visibility"))


@query
def graph_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes, _ = built(spark, sf_dir)
    return nodes.select(
        "id", "label", "type", "href", "summary", stamp(F.col("published_at")).alias("published"),
        joined(F.col("tags")).alias("tags"), F.array_join("search_terms", "|").alias("search_terms"),
        F.col("weight").cast("bigint").alias("weight"),
    )


@query
def graph_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return built(spark, sf_dir)[1].withColumn("confidence", F.round("confidence", 6))


@query
def graph_adjacency(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes, edges = built(spark, sf_dir)
    return graph.adjacency(nodes, edges).select("id", joined(F.col("neighbors")).alias("neighbors"))


def _parts(nodes: DataFrame, edges: DataFrame, *extra: str) -> DataFrame:
    left = nodes.select(*extra, F.lit("node").alias("part"), "id")
    return left.union(edges.select(*extra, F.lit("edge").alias("part"), "id"))


@query
def graph_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes, edges = built(spark, sf_dir)
    wanted = graph.content_matching(nodes, FILTER_GROUPS, age="365d", now=NOW)
    return _parts(*graph.subgraph(nodes, edges, wanted))


@query
def graph_type_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parts(*graph.filter_types(*built(spark, sf_dir), TYPES))


@query
def graph_neighborhood(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Neighbourhoods of all content nodes at once."""
    nodes, edges = built(spark, sf_dir)
    return _parts(*graph.neighborhoods(nodes, edges, graph.content_centers(nodes)), "center")


@query
def graph_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = graph.search_nodes(built(spark, sf_dir)[0], SEARCH)
    place = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.col("bucket").desc(), "node_ord"))  # capped rows
    return found.select("id", F.col("bucket").cast("bigint").alias("bucket"), place.cast("bigint").alias("place"))


@query
def label_neighbors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.label_neighbors(*built(spark, sf_dir)).orderBy("label_node", "title", "item_id")


@query
def graph_edge_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return built(spark, sf_dir)[1].groupBy(graph.edge_kind().alias("edge_kind")).agg(F.count("*").alias("n"))


@query
def graph_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.statistics(*built(spark, sf_dir))


@query
def graph_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Invariants after two label groups lost their edges and weights: broken on purpose, against half the cap."""
    nodes, edges = built(spark, sf_dir)
    hurt = nodes.withColumn("weight", F.when(F.col("type") == "method", F.lit(0)).otherwise(F.col("weight")))
    return graph.violations(hurt, edges.where(~F.col("type").isin("task", "scenario")), SETTINGS.graph_max_nodes // 2)
