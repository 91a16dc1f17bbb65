"""Streams: several micro-batches, late rows, restarts."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from digestry.config import Label, Settings, Taxonomy
from digestry.streaming import daily, ingest
from digestry.streaming.digest import digest_step, latest_state
from tests.test_selection import candidate, COLUMNS

TAXONOMY = Taxonomy((Label("targets", "content", "内容", "Content", ("recommender",)),), ("recommender",))


def files(spark, folder, batches, schema):
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/in-{i}")
    return spark.readStream.schema(spark.read.parquet(f"{folder}/in-0").schema).option("recursiveFileLookup", True).option("maxFilesPerTrigger", 1).parquet(str(folder))


def test_a_table_of_one_or_many_files_is_a_stream(spark, tmp_path):
    spark.range(10).repartition(3).write.parquet(f"{tmp_path}/many.parquet")
    spark.range(10, 15).coalesce(1).write.parquet(f"{tmp_path}/written")
    next((tmp_path / "written").glob("part-*.parquet")).rename(tmp_path / "one.parquet")
    for name, ids in (("many.parquet", range(10)), ("one.parquet", range(10, 15))):
        got = ingest.run_to_table(ingest.read_files(spark, str(tmp_path), name), "t-files")
        assert sorted(r["id"] for r in got.collect()) == list(ids)


def test_repeats_are_dropped_across_batches(spark, tmp_path):
    day = datetime(2026, 8, 1)
    batches = [[("a", 1, day), ("a", 2, day), ("b", 3, day)], [("a", 4, day + timedelta(days=1)), ("c", 5, day)]]
    stream = files(spark, tmp_path, batches, "id string, row_key bigint, published_at timestamp")
    got = ingest.run_to_table(ingest.dedupe(stream, salt="row_key").select("id"), "t-dedupe")
    assert sorted(r["id"] for r in got.collect()) == ["a", "b", "c"]


def test_rows_behind_the_watermark_are_ignored(spark, tmp_path):
    """The watermark of one batch judges lateness from the batch after the next on."""
    day = datetime(2026, 8, 10)
    batches = [[("a", day)], [("b", day)], [("late", day - timedelta(days=8)), ("kept", day - timedelta(days=6))]]
    stream = files(spark, tmp_path, batches, "id string, published_at timestamp")
    got = {r["id"] for r in ingest.run_to_table(ingest.dedupe(stream).select("id"), "t-late").collect()}
    assert got == {"a", "b", "kept"}


def test_history_is_dropped(spark, tmp_path):
    stream = files(spark, tmp_path, [[("a",), ("b",)], [("c",)]], "id string")
    got = ingest.run_to_table(ingest.drop_history(stream, spark.createDataFrame([("b",)], "id string")), "t-anti")
    assert sorted(r["id"] for r in got.collect()) == ["a", "c"]


def test_daily_counts_hold_back_open_days(spark, tmp_path):
    rows = [("x", datetime(2026, 8, 1, 15, 59)), ("x", datetime(2026, 8, 1, 16, 0)), ("x", datetime(2026, 8, 5, 0, 0))]
    stream = files(spark, tmp_path, [rows], "g string, ts timestamp")
    got = ingest.run_to_table(ingest.daily_counts(stream, "ts", "g"), "t-daily")
    assert sorted((str(r["business_date"]), r["n"]) for r in got.collect()) == [("2026-08-01", 1), ("2026-08-02", 1)]


def test_digest_batches_continue_and_may_repeat(spark, tmp_path, now):
    step = digest_step(str(tmp_path), TAXONOMY, Settings(daily_target=2), now)
    first = spark.createDataFrame([candidate(i) for i in range(3)], COLUMNS)
    second = spark.createDataFrame([candidate(i) for i in range(6)], COLUMNS)
    step(first, 0)
    step(second, 1)
    once = sorted(tuple(r) for r in latest_state(spark, str(tmp_path)).collect())
    step(second, 1)  # the same batch again after a failure
    assert sorted(tuple(r) for r in latest_state(spark, str(tmp_path)).collect()) == once
    assert [r[0] for r in sorted(once, key=lambda r: r[1:])] == ["id-0000", "id-0001", "id-0002", "id-0003"]


def test_shared_folder_comes_from_the_session(spark):
    from digestry.session import CHECKPOINT_CONF, scratch_path, shared_dir, stage

    folder = shared_dir(spark)
    assert spark.conf.get(CHECKPOINT_CONF) == folder and scratch_path(spark, "x").startswith(folder)
    staged = stage(spark.range(5).where(F.col("id") > 1), "t")
    assert staged.count() == 3


ARRIVING = COLUMNS + ", arrived_at timestamp"
ZERO = datetime(2026, 8, 1)


def arriving(number, per_day=7):
    """Candidates of several days; every third one comes again two and ten days later under the same id."""
    rows = []
    for day in range(12):
        for i in range(per_day):
            k = day * per_day + i
            rows.append((*candidate(k), ZERO + timedelta(days=day, hours=10)))
            if k % 3 == 0:
                rows += [(*candidate(k), ZERO + timedelta(days=day + later, hours=11)) for later in (2, 10)]
    rows.sort(key=lambda r: r[-1])
    return [rows[i : i + number] for i in range(0, len(rows), number)]


def run_days(spark, folder, batches):
    root = f"{folder}/out"
    stream = daily.delivered_once(files(spark, folder / "in", batches, ARRIVING))
    ids = daily.ingest_step(f"{root}/accepted", [F.col("arrived_at")])
    digest = daily.daily_digest_step(f"{root}/digest", TAXONOMY, Settings(daily_target=3))

    def step(batch, batch_id):
        for _ in range(2):  # as after a failure
            ids(batch, batch_id)
            digest(spark.read.parquet(f"{root}/accepted/version={batch_id}"), batch_id)

    ingest.run_batches(stream, "t-days", step)
    accepted = sorted((r["id"], str(r["arrived_at"])) for r in daily.batches_before(spark, f"{root}/accepted").collect())
    entries = sorted((str(r["digest_date"]), r["kind"], r["rank"], r["id"]) for r in daily.newest(spark, f"{root}/digest", daily.DIGEST_KEYS).collect())
    return accepted, entries


def test_digests_do_not_depend_on_how_rows_are_cut(spark, tmp_path):
    whole = arriving(1000)
    first = {}
    for row in whole[0]:
        first.setdefault(row[3], row[-1])
    results = [run_days(spark, tmp_path / str(number), arriving(number)) for number in (1000, 30)]
    assert results[0] == results[1]
    accepted, entries = results[0]
    assert accepted == sorted((i, str(at)) for i, at in first.items())
    per_day = {}
    for day, kind, rank, _ in entries:
        per_day.setdefault((day, kind), []).append(rank)
    assert all(ranks == list(range(1, len(ranks) + 1)) and len(ranks) <= 3 for ranks in per_day.values()) and max(map(len, per_day.values())) == 3


def test_open_days_are_replaced(spark, tmp_path):
    batches = [[("x", ZERO)], [("x", ZERO + timedelta(hours=1)), ("x", ZERO + timedelta(days=1))], [("y", ZERO + timedelta(days=1))]]
    stream = files(spark, tmp_path / "in", batches, "g string, ts timestamp")
    root = f"{tmp_path}/days"
    ingest.run_batches(ingest.daily_counts(stream, "ts", "g"), "t-open", daily.open_days_step(root), mode="update")
    got = sorted((str(r["business_date"]), r["g"], r["n"]) for r in daily.newest(spark, root, ["business_date", "g"]).collect())
    assert got == [("2026-08-01", "x", 2), ("2026-08-02", "x", 1), ("2026-08-02", "y", 1)]


def test_an_unfinished_batch_is_not_read(spark, tmp_path):
    daily.write_batch(spark.createDataFrame([("a",)], "id string"), str(tmp_path), 0)
    (tmp_path / "version=1").mkdir()
    spark.createDataFrame([("b",)], "id string").write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").mode("overwrite").parquet(f"{tmp_path}/version=1")
    assert [r["id"] for r in daily.batches_before(spark, str(tmp_path)).collect()] == ["a"]
    assert daily.batches_before(spark, str(tmp_path), 0) is None


def test_batches_do_not_grow_with_files(spark):
    """A large table makes many files for each arrival; here every partition of the shuffle makes one."""
    from digestry.plans import q_streams

    rows = spark.range(400).select(
        F.concat(F.lit("i"), F.col("id") % 90).alias("id"), F.col("id").alias("row_key"), F.lit("s").alias("source_id"), F.lit(1.0).alias("source_weight"),
        F.lit(ZERO).alias("published_at"), (F.col("id") % q_streams.ARRIVALS).alias("arrival"), F.lit(ZERO).alias("arrived_at"),
    )
    numbers = []
    spark.conf.set("spark.sql.adaptive.enabled", False)
    try:
        stream = q_streams.arrivals(rows)
        ingest.run_batches(stream, "t-arrivals", lambda batch, number: numbers.append((number, batch.count())))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", True)
    assert len(numbers) <= q_streams.BATCHES and sum(n for _, n in numbers) == rows.select("id", "arrival").distinct().count()
