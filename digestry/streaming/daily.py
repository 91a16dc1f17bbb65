"""Ingest and digests over many micro-batches: what a batch adds is a table of its own, readers take the newest rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from digestry.config import Settings, Taxonomy
from digestry.functions.times import business_date
from digestry.operators.collect import in_window
from digestry.operators.prefilter import annotate, score_order
from digestry.operators.select_best import best_per_key, keep_best
from digestry.session import stage
from digestry.sources.item_store import committed_versions

Step = Callable[[DataFrame, int], None]
DIGEST_KEYS = ("digest_date", "kind")


def batches_before(spark: SparkSession, root: str, batch_id: int | None = None) -> DataFrame | None:
    """Rows (with `version`, the batch) of all finished batches before one; None where there are none."""
    done = [v for v in committed_versions(spark, root) if batch_id is None or v < batch_id]
    if not done:
        return None
    return spark.read.option("basePath", root).parquet(*(f"{root}/version={v}" for v in done))


def write_batch(rows: DataFrame, root: str, batch_id: int) -> None:
    """A batch that comes again after a failure replaces what it wrote before."""
    rows.write.mode("overwrite").parquet(f"{root}/version={batch_id}")


def newest(spark: SparkSession, root: str, keys: Sequence[str], batch_id: int | None = None) -> DataFrame | None:
    """For each key all rows of the last batch that wrote it.

    The last batch of a key is a grouped maximum, joined back; keys are days or
    days and kinds, so that side is small.
    """
    rows = batches_before(spark, root, batch_id)
    if rows is None:
        return None
    last = rows.groupBy(*keys).agg(F.max("version").alias("version"))
    return rows.join(last, [*keys, "version"], "left_semi").drop("version")


def delivered_once(stream: DataFrame, key: str = "id", arrived: str = "arrived_at", delay: str = "7 days") -> DataFrame:
    """Rows without those of the same key and arrival that come again, by keyed state that a watermark bounds.

    The watermark follows the arrival of rows, not their publication, so old
    papers that arrive late are rows like others. A key that arrives anew passes:
    which of its rows counts is decided in `ingest_step`, in an order that does not
    depend on how files are cut into batches.
    """
    return stream.withWatermark(arrived, delay).dropDuplicatesWithinWatermark([key, arrived])


def ingest_step(root: str, order: Sequence[Column], key: str = "id") -> Step:
    """Accept the first row, in the given order, of every key that no earlier batch has accepted.

    With the arrival leading the order and arrivals read in turn, the result is the
    first arrival of every key whatever the batches are. A key with very many
    copies is pruned in each input partition; of earlier batches only the keys are
    read. A repeated batch compares with the batches before it alone, so it accepts
    the same rows again.
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        before = batches_before(batch.sparkSession, root, batch_id)
        best = keep_best(batch, [key], order)
        write_batch(best if before is None else best.join(before.select(key), key, "left_anti"), root, batch_id)

    return step


def score_arrivals(rows: DataFrame, taxonomy: Taxonomy, settings: Settings, keep: Sequence[str] = ()) -> DataFrame:
    """Rows scored by the clock of their own arrival, as row-local work of the scan; the text ends here.

    `fit` marks rows with evidence inside their window. Texts of rows outside it are
    not looked at: such a row is nothing but the first arrival of its id.
    """
    clock = F.col("arrived_at")
    timely = F.coalesce(in_window(F.col("published_at"), F.col("kind"), clock, None), F.lit(False))
    seen = rows.withColumn("timely", timely).withColumn("excerpt", F.when(F.col("timely"), F.col("excerpt")))
    scored = annotate(seen, taxonomy, settings, clock, keep=("arrived_at", "timely", *keep))
    return scored.select(
        "id", "kind", "row_key", "source_id", "source_weight", "published_at", "arrived_at", *keep, "metadata_score",
        (F.col("timely") & F.col("has_evidence")).alias("fit"),
    )


def scored_digest_step(root: str, daily_target: int) -> Step:
    """Keep the best fit rows for each business day of arrival and kind, however the rows are cut into batches.

    The state is the current digests; a batch takes those of the days it touches,
    adds its own best rows and writes them again. Best of best is best, and ids are
    unique (see `ingest_step`), so order and size of batches do not matter. State
    grows by the daily target for each day and kind.
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        rows = batch.where("fit").select(
            business_date(F.col("arrived_at")).alias("digest_date"), "kind", "id", "source_id", "published_at", "metadata_score"
        )
        top = stage(best_per_key(rows, DIGEST_KEYS, score_order(), daily_target, "rank"), "batch-best")
        before = newest(batch.sparkSession, root, DIGEST_KEYS, batch_id)
        if before is not None:
            top = before.join(top.select(*DIGEST_KEYS).distinct(), list(DIGEST_KEYS), "left_semi").unionByName(top)
        write_batch(best_per_key(top.drop("rank"), DIGEST_KEYS, score_order(), daily_target, "rank"), root, batch_id)

    return step


def daily_digest_step(root: str, taxonomy: Taxonomy, settings: Settings) -> Step:
    """`scored_digest_step` for batches that still carry their texts: each row is scored first."""
    digest = scored_digest_step(root, settings.daily_target)

    def step(batch: DataFrame, batch_id: int) -> None:
        digest(score_arrivals(batch, taxonomy, settings), batch_id)

    return step


def open_days_step(root: str) -> Step:
    """Sink for aggregates in update mode: a batch holds the days that changed, with their counts up to now."""

    def step(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, root, batch_id)

    return step
