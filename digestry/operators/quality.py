"""Row contracts, path checks and the publish gate."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from digestry.config import GROUPS, Taxonomy
from digestry.functions.text import has_text

# Identifiers that are safe in a path, and the accepted content bases.
ID_PATTERN = r"^[A-Za-z0-9._~-]+$"
BASES = {
    "paper": ("mineru_full_text", "abstract_fallback"),
    "blog": ("rss_full_content", "article_html", "excerpt_fallback"),
}
ITEM_PATH = r"items/(papers|blogs)/([0-9]{4})/(0[1-9]|1[0-2])/([^/]+)\.json$"
DIGEST_PATH = r"digests/([0-9]{4})/(0[1-9]|1[0-2])/([0-9]{4}-[0-9]{2}-[0-9]{2})\.json$"
RUN_PATH = r"runs/([0-9]{4})/(0[1-9]|1[0-2])/([^/]+)\.json$"


def broken_rules(rules: Mapping[str, Column]) -> Column:
    """Names of the rules that do not hold; an unknown outcome counts as broken."""
    checks = [F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules.items()]
    return F.array_compact(F.array(*checks))


def violations(df: DataFrame, key: str, rules: Mapping[str, Column]) -> DataFrame:
    return df.select(key, F.explode(broken_rules(rules)).alias("rule"))


def _clean_list(values: Column) -> Column:
    return F.forall(values, has_text) & (F.size(F.array_distinct(values)) == F.size(values))


def item_rules(taxonomy: Taxonomy) -> dict[str, Column]:
    """Contract of one item row."""
    rules = {
        "kind": F.col("kind").isin("paper", "blog"),
        "id": F.col("id").rlike(ID_PATTERN),
        "title": has_text(F.col("title")),
        "summary": has_text(F.col("summary")),
        "source": has_text(F.col("source")),
        "url": F.col("url").rlike(r"^https?://[^/?#]"),
        "published_at": F.col("published_at").isNotNull(),
        "authors": _clean_list(F.col("authors")),
        "relevance_score": F.col("relevance_score").between(0, 1),
        "final_score": F.col("final_score").between(0, 1),
    }
    for group in GROUPS:
        known = [label.id for label in taxonomy.group(group)]
        column = F.col(group)
        rules[group] = _clean_list(column) & F.forall(column, lambda v: v.isin(*known))
    return rules


def basis_rule(kind: Column, basis: Column) -> Column:
    return F.when(kind == "paper", basis.isin(*BASES["paper"])).otherwise(basis.isin(*BASES["blog"]))


def path_violations(items: DataFrame, path: Column) -> DataFrame:
    """Item files whose place disagrees with their content."""
    folder = F.when(F.col("kind") == "paper", F.lit("papers")).otherwise(F.lit("blogs"))
    rules = {
        "path_shape": path.rlike(ITEM_PATH),
        "path_kind": F.regexp_extract(path, ITEM_PATH, 1) == folder,
        "path_id": F.regexp_extract(path, ITEM_PATH, 4) == F.col("id"),
        "path_month": F.concat(F.regexp_extract(path, ITEM_PATH, 2), F.lit("-"), F.regexp_extract(path, ITEM_PATH, 3))
        == F.date_format("published_at", "yyyy-MM"),
    }
    return items.select("id", F.explode(broken_rules(rules)).alias("rule"))


def digest_path_violations(digests: DataFrame, path: Column) -> DataFrame:
    day = F.date_format("digest_date", "yyyy-MM-dd")
    rules = {
        "path_shape": path.rlike(DIGEST_PATH),
        "path_date": F.regexp_extract(path, DIGEST_PATH, 3) == day,
        "path_month": F.concat_ws("-", F.regexp_extract(path, DIGEST_PATH, 1), F.regexp_extract(path, DIGEST_PATH, 2))
        == F.date_format("digest_date", "yyyy-MM"),
    }
    return digests.select("digest_date", F.explode(broken_rules(rules)).alias("rule"))


def run_path_violations(runs: DataFrame, path: Column) -> DataFrame:
    rules = {
        "path_shape": path.rlike(RUN_PATH),
        "path_id": F.regexp_extract(path, RUN_PATH, 3) == F.col("run_id"),
        "path_month": F.concat_ws("-", F.regexp_extract(path, RUN_PATH, 1), F.regexp_extract(path, RUN_PATH, 2))
        == F.date_format("started_at", "yyyy-MM"),
    }
    return runs.select("run_id", F.explode(broken_rules(rules)).alias("rule"))


def unsupported_files(files: DataFrame) -> DataFrame:
    """Listing rows (path) that are not JSON and therefore must not be in the canonical tree."""
    return files.where(~F.col("path").rlike(r"\.json$"))


def forbidden_files(files: DataFrame, suffixes: Sequence[str] = (".html", ".htm", ".pdf", ".xml")) -> DataFrame:
    """Raw source payloads that must never be published."""
    pattern = "(?i)(" + "|".join(s.replace(".", r"\.") for s in suffixes) + ")$"
    return files.where(F.col("path").rlike(pattern))


def manifest_violations(manifests: DataFrame) -> DataFrame:
    """Stage outputs belong together only if they agree on run and schema version."""
    counted = manifests.agg(
        F.count_distinct("run_id").alias("runs"), F.count_distinct("schema_version").alias("versions")
    )
    return counted.select(
        F.explode(
            F.array_compact(
                F.array(
                    F.when(F.col("runs") != 1, F.lit("run_id")), F.when(F.col("versions") != 1, F.lit("schema_version"))
                )
            )
        ).alias("rule")
    )


def overflow(candidates: DataFrame, cap: int) -> DataFrame:
    """Kinds with more candidates than one run may read."""
    return candidates.groupBy("kind").agg(F.count("*").alias("n")).where(F.col("n") > cap)


def long_excerpts(candidates: DataFrame, limit: int, key: str = "id") -> DataFrame:
    return candidates.where((F.col("kind") == "blog") & (F.length("excerpt") > limit)).select(
        key, F.length("excerpt").alias("n_chars")
    )


def publish_gate(checks: Mapping[str, DataFrame]) -> DataFrame:
    """(check, violations) for all checks; publishing goes ahead only if every count is zero."""
    result = None
    for name, broken in checks.items():
        part = broken.agg(F.count("*").alias("violations")).select(F.lit(name).alias("check"), "violations")
        result = part if result is None else result.union(part)
    return result.withColumn("passed", F.col("violations") == 0)
