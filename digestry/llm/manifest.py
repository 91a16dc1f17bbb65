"""Merkle manifest of a dataset: leaves, roots for each source and in all, proofs, and tampering found by folding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from digestry.llm.ordered import running_sums
from digestry.llm.texts import crc_mod, lower_ascii
from digestry.session import stage

# Children of a node, and hex digits of a digest.
FAN = 16
HEX = 64
# Nodes of one aligned block: two levels of the tree. Whatever a source holds, a row of levels is at most 16 KB.
BLOCK = FAN * FAN
LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def field(value: Column) -> Column:
    """`-` for null, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(*parts: Column) -> Column:
    """Lower-case hex sha256 of the parts, one after the other."""
    return F.sha2(F.concat(*parts), 256)


def leaf(text: Column | None = None) -> Column:
    """Digest of a row of documents, with another text if one is given."""
    return digest(*(field(F.col(c) if c != "text" or text is None else text) for c in LEAF_COLUMNS))


def is_tampered(divisor: int = 5) -> Column:
    """Rows whose doc_id's crc32 the divisor divides; a row without doc_id is left alone."""
    return F.col("doc_id").isNotNull() & (crc_mod(F.col("doc_id"), divisor) == 0)


def tampered_leaf(divisor: int = 5) -> Column:
    """Digest of a row whose text was lower-cased, null for a row that is left alone."""
    return F.when(is_tampered(divisor), leaf(lower_ascii(F.col("text"))))


def parents(level: Column) -> Column:
    """The next level of a block: each run of 16 digests of the string (the last may be shorter) by its digest."""
    run = FAN * HEX
    starts = F.sequence(F.lit(0), F.floor((F.length(level) - 1) / run).cast("int"))
    return F.array_join(F.transform(starts, lambda i: F.sha2(F.substring(level, i * run + 1, F.lit(run)), 256)), "")


def blocks_of(nodes: DataFrame) -> DataFrame:
    """One row for each aligned block of nodes (group, pos, digest, n = nodes of the group, carried = anything).

    `level0` is the digests of the block in order as one string, `level1` that of
    their parents, `top` the block's own node. A group of at most one block stops
    at the level that has a single node; `depth` counts the levels hashed.
    A block has at most 256 nodes, so a group of any size is spread over tasks.
    """
    held = nodes.groupBy("group", (F.col("pos") / BLOCK).cast("long").alias("block"), "n").agg(
        F.array_sort(F.collect_list(F.struct("pos", "digest", "carried"))).alias("entries")
    )
    depth = F.when(F.col("n") <= 1, 0).when(F.col("n") <= FAN, 1).otherwise(2)
    level0 = F.array_join(F.col("entries.digest"), "")
    return (
        held.withColumns({"depth": depth, "level0": level0})
        .withColumn("level1", F.when(F.col("depth") > 0, parents(F.col("level0"))))
        .withColumn("top", F.when(F.col("depth") == 0, F.col("level0")).when(F.col("depth") == 1, F.col("level1")).otherwise(parents(F.col("level1"))))
    )


def as_nodes(blocks: DataFrame) -> DataFrame:
    """The blocks of each group as its nodes of the next round."""
    return blocks.select(
        "group", F.col("block").alias("pos"), F.col("top").alias("digest"), F.ceil(F.col("n") / BLOCK).cast("long").alias("n"), F.lit(None).cast("string").alias("carried")
    )


def tree(nodes: DataFrame, name: str) -> list[DataFrame]:
    """Rounds of blocks, each a written table, until every group has a single one.

    A round has at most one row for 256 of the one before.
    """
    rounds = [stage(blocks_of(nodes), f"{name}-0")]
    while rounds[-1].where(F.col("n") > BLOCK).limit(1).count():
        rounds.append(stage(blocks_of(as_nodes(rounds[-1])), f"{name}-{len(rounds)}"))
    return rounds


def flanks(level: Column, place: Column) -> Column:
    """(left, right): what stands before and after a digest in its run of 16."""
    start = F.floor(place / FAN) * FAN
    left = F.substring(level, (start * HEX + 1).cast("int"), ((place - start) * HEX).cast("int"))
    right = F.substring(level, ((place + 1) * HEX + 1).cast("int"), ((start + FAN - 1 - place) * HEX).cast("int"))
    return F.struct(left.alias("left"), right.alias("right"))


def open_blocks(blocks: DataFrame) -> DataFrame:
    """group, pos, digest, carried and `path` for each node of blocks that have their own `path`: lowest level first."""
    place = F.col("entry.pos") - F.col("block") * BLOCK
    own = F.when(F.col("depth") == 0, F.array().cast("array<struct<left:string,right:string>>")).when(F.col("depth") == 1, F.array(flanks(F.col("level0"), place))).otherwise(
        F.array(flanks(F.col("level0"), place), flanks(F.col("level1"), F.floor(place / FAN)))
    )
    return blocks.select("*", F.explode("entries").alias("entry")).select(
        "group", F.col("entry.pos").alias("pos"), F.col("entry.digest").alias("digest"), F.col("entry.carried").alias("carried"), F.concat(own, F.col("path")).alias("path")
    )


def descend(rounds: list[DataFrame], tops: DataFrame) -> DataFrame:
    """Paths of all nodes of a tree; `tops` has the path of each group's last node (group, path, and columns that all its nodes get).

    What is joined is the blocks, one row for up to 256 nodes, never the nodes.
    """
    extra = [c for c in tops.columns if c not in ("group", "path")]
    at = tops.withColumn("pos", F.lit(0).cast("long"))
    for blocks in rounds[::-1]:
        up = at.select(F.col("group").alias("_group"), F.col("pos").alias("_pos"), "path", *extra)
        joined = blocks.join(up, blocks["group"].eqNullSafe(up["_group"]) & (blocks["block"] == up["_pos"]))
        opened = open_blocks(joined.withColumn("entries", F.transform("entries", lambda e: F.struct(e["pos"].alias("pos"), e["digest"].alias("digest"), F.struct(e["carried"].alias("own"), *extra).alias("carried")))))
        at = opened.select("group", "pos", "digest", F.col("carried.own").alias("carried"), "path", *(F.col(f"carried.{c}").alias(c) for c in extra))
    return at


def fold(node: Column, path: Column) -> Column:
    """The root that a digest and its siblings give."""
    return F.aggregate(path, node, lambda d, s: digest(s["left"], d, s["right"]))


def proof_text(path: Column) -> Column:
    """All siblings of a path as one text, level by level, left to right."""
    return F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), "")


def merkle_manifest(docs: DataFrame, divisor: int = 5) -> DataFrame:
    """Leaf, roots and proof of every row, and whether its (partly tampered) text still leads to the root.

    One row for each row of `docs`: doc_id, leaf, source, subroot, root, `path`
    (structs of the sibling digests left and right of it, lowest level first),
    found (the leaf of the text as it is found) and tampered. Rows are ordered in
    their source by doc_id (null first), rows of one doc_id by leaf; sources by
    code point, null first, as a source of its own. Null fields have their own
    mark, so a null text differs from an empty one. Repeated rows are leaves each.
    An empty table has no rows and no root. Other columns are left aside.

    Texts are hashed where they are read; later steps move digests. Positions
    come from range-partitioned running sums, so a source may have any share of
    the rows. Levels are strings of digests for aligned blocks of 256 nodes.
    """
    found = F.coalesce(tampered_leaf(divisor), F.col("leaf"))
    leaves = docs.select(*LEAF_COLUMNS).withColumn("leaf", leaf()).select("doc_id", "source", "leaf", found.alias("found"), is_tampered(divisor).alias("tampered"), F.lit(1).alias("one"))
    order = [F.col("source").asc_nulls_first(), F.col("doc_id").asc_nulls_first(), F.col("leaf")]
    placed = running_sums(leaves, order, {"pos": "one"}, within=["source"], name="leaves")
    sizes = stage(leaves.groupBy("source").agg(F.count("*").alias("n")), "sizes").withColumnRenamed("source", "_source")
    carried = F.struct("doc_id", "found", "tampered")
    nodes = placed.join(sizes, placed["source"].eqNullSafe(sizes["_source"])).select(F.col("source").alias("group"), "pos", F.col("leaf").alias("digest"), "n", carried.alias("carried"))
    by_source = tree(nodes, "source")
    # The last round has one block for each source, with its subroot.
    subroots = by_source[-1].select(F.col("group").alias("source"), F.col("top").alias("subroot"), F.lit(1).alias("one"))
    ranked = running_sums(subroots, [F.col("source").asc_nulls_first()], {"pos": "one"}, name="subroots")
    n_sources = F.lit(sizes.count()).cast("long").alias("n")
    tops = tree(ranked.select(F.lit("all").alias("group"), "pos", F.col("subroot").alias("digest"), n_sources, F.col("source").alias("carried")), "root")
    root = tops[-1].select("group", F.col("top").alias("root"), F.array().cast("array<struct<left:string,right:string>>").alias("path"))
    starts = descend(tops, root).select(F.col("carried").alias("group"), F.col("digest").alias("subroot"), "root", "path")
    paths = descend(by_source, stage(starts, "paths"))
    return paths.select(
        F.col("carried.doc_id").alias("doc_id"), F.col("digest").alias("leaf"), F.col("group").alias("source"), "subroot", "root", "path", F.col("carried.found").alias("found"), F.col("carried.tampered").alias("tampered")
    )


def manifest_digest(docs: DataFrame) -> DataFrame:
    """The manifest with each proof as a digest, the root that the found text folds to, and whether that is the root."""
    rows = merkle_manifest(docs).withColumn("folded_root", fold(F.col("found"), F.col("path")))
    proof = F.sha2(proof_text(F.col("path")), 256).alias("proof_sha256")
    return rows.select("doc_id", "leaf", "subroot", "root", proof, "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"), "tampered")
