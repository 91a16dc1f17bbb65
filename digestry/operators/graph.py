"""Knowledge graph of the most visible items and questions to it.

The number of content nodes is capped by configuration, which bounds every
frame built from them; the work that grows with the data is choosing the items
and selecting their relations.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from digestry.config import GROUPS, Taxonomy
from digestry.functions.times import AGE_BUCKETS, age_days
from digestry.operators.items import explode_labels
from digestry.operators.search import search_form

CONTENT_TYPES = ("paper", "article")
# What marks an edge as coming from the taxonomy.
TAXONOMY_EVIDENCE = "canonical taxonomy label"
TAXONOMY_AUTHOR = "topics.yaml"
MINIMUM_CONFIDENCE = 0.5


def is_content(kind: Column) -> Column:
    return kind.isin(*CONTENT_TYPES)


def visible_items(
    items: DataFrame, relation_counts: DataFrame, now: datetime, recent_days: int, cap: int
) -> DataFrame:
    """The items shown in the graph: recent ones first, then by relevance and number of relations."""
    counted = items.join(relation_counts.select("id", "relations"), "id", "left")
    recent = age_days(F.col("published_at"), F.lit(now).cast("timestamp")) <= recent_days
    score = (
        F.when(recent, F.lit(2.0)).otherwise(F.lit(0.0))
        + F.col("relevance_score")
        + F.coalesce("relations", F.lit(0)) * F.lit(0.03)
    )
    return (
        counted.withColumn("visibility", score)
        .orderBy(F.col("visibility").desc(), F.col("published_at").desc(), F.col("id"))
        .limit(cap)
    )


def _singular(group: Column) -> Column:
    return F.regexp_replace(group, "s$", "")


def content_nodes(visible: DataFrame, base: str = "/") -> DataFrame:
    paper = F.col("kind") == "paper"
    tags = F.concat(*[F.col(group) for group in GROUPS])
    return visible.select(
        "id",
        F.col("title").alias("label"),
        F.when(paper, F.lit("paper")).otherwise(F.lit("article")).alias("type"),
        F.concat(F.lit(base), F.when(paper, F.lit("papers/")).otherwise(F.lit("articles/")), "id", F.lit("/")).alias("href"),
        F.col("summary").alias("summary"),
        "published_at",
        tags.alias("tags"),
        F.concat(F.array("title"), tags).alias("search_terms"),
        F.struct(F.lit(0).alias("a"), (-F.col("visibility")).alias("b"), (-F.unix_micros("published_at")).alias("c"), F.col("id").alias("d")).alias("node_ord"),
    )


def taxonomy_nodes(visible: DataFrame, taxonomy_frame: DataFrame) -> DataFrame:
    """Labels in use by visible items, one node each."""
    used = explode_labels(visible, "id").select("grp", F.col("label").alias("label_id")).distinct()
    dims = taxonomy_frame.withColumnRenamed("id", "label_id").withColumn("group_ord", _group_order(F.col("grp")))
    return dims.join(used, ["grp", "label_id"], "left_semi").select(
        F.concat(_singular(F.col("grp")), F.lit(":"), "label_id").alias("id"),
        F.concat_ws(" / ", "name_zh", "name_en").alias("label"),
        _singular(F.col("grp")).alias("type"),
        F.lit(None).cast("string").alias("href"),
        F.lit(None).cast("string").alias("summary"),
        F.lit(None).cast("timestamp").alias("published_at"),
        F.array().cast("array<string>").alias("tags"),
        F.array("label_id", "name_zh", "name_en").alias("search_terms"),
        F.struct(
            F.lit(1).alias("a"), F.col("group_ord").cast("double").alias("b"),
            F.col("ord").cast("bigint").alias("c"), F.lit("").alias("d"),
        ).alias("node_ord"),
    )


def _group_order(group: Column) -> Column:
    order = F.lit(len(GROUPS))
    for position, name in enumerate(GROUPS):
        order = F.when(group == name, F.lit(position)).otherwise(order)
    return order


def taxonomy_edges(visible: DataFrame) -> DataFrame:
    pairs = explode_labels(visible, "id").select("id", "grp", "label").distinct()
    target = F.concat(_singular(F.col("grp")), F.lit(":"), "label")
    return pairs.select(
        F.concat(F.lit("taxonomy:"), "id", F.lit("|"), target).alias("id"),
        F.col("id").alias("source"),
        target.alias("target"),
        _singular(F.col("grp")).alias("type"),
        F.lit(1.0).alias("confidence"),
        F.lit(TAXONOMY_EVIDENCE).alias("evidence"),
        F.lit(TAXONOMY_AUTHOR).alias("generated_by"),
    )


def relation_edges(visible: DataFrame, relations: DataFrame, taxonomy_frame: DataFrame) -> DataFrame:
    """Confident relations of visible items, resolved to a visible item or else to a label, first of each kept.

    The visible ids are few and staged with their size, so the planner broadcasts
    them against the relations; with an unusually large cap it would not.
    """
    ids = visible.select("id")
    own = relations.where(F.col("confidence") >= MINIMUM_CONFIDENCE).join(ids, "id", "left_semi")
    targets = visible.select(F.col("id").alias("target_id"), F.col("id").alias("item_target"))
    labels = taxonomy_frame.select(
        F.col("id").alias("target_id"), F.concat(_singular(F.col("grp")), F.lit(":"), "id").alias("label_target")
    )
    resolved = (
        own.join(targets, "target_id", "left")
        .join(labels, "target_id", "left")
        .withColumn("target", F.coalesce("item_target", "label_target"))
        .where(F.col("target").isNotNull() & (F.col("target") != F.col("id")))
    )
    first = F.min_by(F.struct("confidence", "evidence", "generated_by"), "pos").alias("f")
    return resolved.groupBy("id", "target", "type").agg(first).select(
        F.concat(F.lit("relation:"), "id", F.lit("|"), "target", F.lit("|"), "type").alias("id"),
        F.col("id").alias("source"),
        "target",
        "type",
        "f.confidence",
        "f.evidence",
        "f.generated_by",
    )


def both_ways(edges: DataFrame) -> DataFrame:
    """(node, other) pairs of an undirected reading of the edges."""
    there = edges.select(F.col("source").alias("node"), F.col("target").alias("other"))
    back = edges.select(F.col("target").alias("node"), F.col("source").alias("other"))
    return there.union(back).distinct()


def with_weights(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Weight of a node: number of distinct neighbours, at least one."""
    degree = both_ways(edges).groupBy("node").agg(F.count("*").alias("degree"))
    joined = nodes.join(degree, nodes["id"] == degree["node"], "left")
    return joined.select(*nodes.columns, F.greatest(F.lit(1), F.coalesce("degree", F.lit(0))).alias("weight"))


def build_graph(
    visible: DataFrame, relations: DataFrame, taxonomy: Taxonomy, base: str = "/"
) -> tuple[DataFrame, DataFrame]:
    """(nodes, edges) of the visible items."""
    dims = taxonomy.frame(visible.sparkSession)
    edges = taxonomy_edges(visible).union(relation_edges(visible, relations, dims))
    nodes = content_nodes(visible, base).union(taxonomy_nodes(visible, dims))
    return with_weights(nodes, edges), edges


def adjacency(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Neighbours of every node, isolated nodes included."""
    near = both_ways(edges).groupBy("node").agg(F.array_sort(F.collect_set("other")).alias("neighbors"))
    joined = nodes.join(near, nodes["id"] == near["node"], "left")
    return joined.select(nodes["id"], F.coalesce("neighbors", F.array().cast("array<string>")).alias("neighbors"))


def content_matching(
    nodes: DataFrame, groups: Mapping[str, Sequence[str]] | None = None, year: str | None = None,
    age: str | None = None, now: datetime | None = None,
) -> DataFrame:
    """Content nodes with any selected label of every selected group and inside the time filter."""
    condition = is_content(F.col("type"))
    for values in (groups or {}).values():
        if values:
            condition = condition & F.arrays_overlap("tags", F.array(*[F.lit(v) for v in values]))
    if year or age:
        condition = condition & F.col("published_at").isNotNull()
    if year:
        condition = condition & (F.date_format("published_at", "yyyy") == year)
    if age:
        days = {f"{bound}d": bound for bound in AGE_BUCKETS}[age]
        condition = condition & (age_days(F.col("published_at"), F.lit(now).cast("timestamp")) <= days)
    return nodes.where(condition).select("id")


def _between(edges: DataFrame, ids: DataFrame, *extra: str) -> DataFrame:
    """Edges with both ends among the ids."""
    starts = ids.select(*extra, F.col("id").alias("source"))
    ends = ids.select(*extra, F.col("id").alias("target"))
    return edges.join(starts, [*extra, "source"], "left_semi").join(ends, [*extra, "target"], "left_semi")


def subgraph(nodes: DataFrame, edges: DataFrame, content_ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The given content, its directly connected taxonomy nodes and the edges among them."""
    content = nodes.where(is_content(F.col("type"))).join(content_ids, "id", "left_semi").select("id")
    labels = nodes.where(~is_content(F.col("type"))).select(F.col("id").alias("other"))
    touched = both_ways(edges).join(content.withColumnRenamed("id", "node"), "node", "left_semi")
    linked = touched.join(labels, "other", "left_semi").select(F.col("other").alias("id")).distinct()
    ids = content.union(linked)
    return nodes.join(ids, "id", "left_semi"), _between(edges, ids)


def filter_types(nodes: DataFrame, edges: DataFrame, types: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Only the given node types; labels that lose all their edges go, content stays."""
    kept = nodes.where(F.col("type").isin(*types))
    visible = _between(edges, kept.select("id"))
    connected = both_ways(visible).select(F.col("node").alias("id")).distinct()
    content = kept.where(is_content(F.col("type")))
    labels = kept.where(~is_content(F.col("type"))).join(connected, "id", "left_semi")
    return content.union(labels), visible


def neighborhoods(nodes: DataFrame, edges: DataFrame, centers: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One-hop neighbourhoods of many centres at once, with the edges inside each; absent centres give no rows."""
    known = centers.join(nodes.select(F.col("id").alias("center")), "center", "left_semi").distinct()
    near = known.join(both_ways(edges), F.col("center") == F.col("node")).select("center", F.col("other").alias("id"))
    ids = known.select("center", F.col("center").alias("id")).union(near).distinct()
    starts = ids.select("center", F.col("id").alias("source"))
    ends = ids.select("center", F.col("id").alias("target"))
    inner = edges.join(starts, "source").join(ends, ["center", "target"], "left_semi")
    return ids, inner


def content_centers(nodes: DataFrame) -> DataFrame:
    """Nodes that may be the centre of a view: content only."""
    return nodes.where(is_content(F.col("type"))).select(F.col("id").alias("center"))


def search_nodes(nodes: DataFrame, query: str) -> DataFrame:
    """Nodes containing every query word; exact matches first, then prefixes, graph order inside a bucket."""
    wanted = search_form(F.lit(query))
    texts = F.coalesce("search_terms", "tags")
    hay = search_form(F.concat_ws(" ", "id", "label", F.array_join(texts, " ")))
    found = F.forall(F.split(wanted, " "), lambda term: F.contains(hay, term)) & (F.length(wanted) > 0)
    node_id, label = search_form(F.col("id")), search_form(F.col("label"))
    exact = (node_id == wanted) | (label == wanted) | F.exists(texts, lambda t: search_form(t) == wanted)
    prefix = node_id.startswith(wanted) | label.startswith(wanted)
    bucket = F.when(exact, F.lit(3)).when(prefix, F.lit(2)).otherwise(F.lit(1))
    return nodes.where(found).withColumn("bucket", bucket).orderBy(F.col("bucket").desc(), "node_ord")


def label_neighbors(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Content next to every label."""
    kinds = nodes.select(F.col("id").alias("node"), F.col("type").alias("node_type"))
    content = nodes.where(is_content(F.col("type"))).select(F.col("id").alias("other"), F.col("label").alias("title"))
    pairs = both_ways(edges).join(kinds.where(~is_content(F.col("node_type"))), "node")
    return pairs.join(content, "other").select(
        F.col("node").alias("label_node"), F.col("other").alias("item_id"), "title"
    )


def edge_kind() -> Column:
    from_taxonomy = F.col("id").startswith("taxonomy:") | (F.col("generated_by") == TAXONOMY_AUTHOR)
    return F.when(from_taxonomy, F.lit("taxonomy")).otherwise(F.lit("model"))


def statistics(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Content nodes and edges of a graph, one row."""
    counted = nodes.agg(F.count_if(is_content(F.col("type"))).alias("content_nodes"), F.count("*").alias("nodes"))
    return counted.withColumn("edges", edges.agg(F.count("*")).scalar())


def violations(nodes: DataFrame, edges: DataFrame, cap: int) -> DataFrame:
    """Broken invariants: weights must be positive, labels must touch content, content must respect the cap."""
    bad_weight = nodes.where(~(F.coalesce("weight", F.lit(0)) > 0)).select("id", F.lit("bad_weight").alias("rule"))
    content = nodes.where(is_content(F.col("type"))).select(F.col("id").alias("other"))
    touching = both_ways(edges).join(content, "other", "left_semi").select(F.col("node").alias("id"))
    lonely = nodes.where(~is_content(F.col("type"))).join(touching, "id", "left_anti")
    too_many = nodes.agg(F.count_if(is_content(F.col("type"))).alias("n")).where(F.col("n") > cap)
    return (
        bad_weight.union(lonely.select("id", F.lit("isolated_label").alias("rule")))
        .union(too_many.select(F.col("n").cast("string").alias("id"), F.lit("too_many_nodes").alias("rule")))
    )
