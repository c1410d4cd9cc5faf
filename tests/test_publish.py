import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import rows_of
from small import EARLY, LATE, ROWS, small_catalog
from snapwright.plans.run import Settings, run, snapshot_table
from snapwright.plans.snapshot import build_snapshot
from snapwright.sources.published import MERGE_AFTER, PublishedTable, run_report, stale_ids
from snapwright.sources.storage import scratch_root

SCHEMA = T.StructType().add("id", T.LongType(), False).add("text", T.StringType())
SETTINGS = Settings(dimension=8)


def frame(spark, rows):
    return spark.createDataFrame(rows, "id long, text string")


def ids(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "id long")


def content(table, commit=None):
    return sorted((r.id, r.text) for r in table.read(commit).collect())


@pytest.fixture
def table(spark, tmp_path):
    return PublishedTable(spark, str(tmp_path / "t"), SCHEMA, "id")


def test_empty_table(table):
    assert content(table) == [] and table.watermark() is None and not table.exists()


def test_full_then_changes(spark, table):
    table.publish_all(frame(spark, [(1, "a"), (1, "b"), (2, "c"), (3, "d")]), watermark="w1")
    first = table.latest()
    table.publish_changes(frame(spark, [(1, "new")]), ids(spark, 3, 3, 99), watermark="w2")
    assert content(table) == [(1, "new"), (2, "c")]
    assert table.watermark() == "w2"
    # An older version stays readable.
    assert content(table, first) == [(1, "a"), (1, "b"), (2, "c"), (3, "d")]
    # An id may come back and change again.
    table.publish_changes(frame(spark, [(3, "back"), (1, "newer")]), ids(spark))
    assert content(table) == [(1, "newer"), (2, "c"), (3, "back")] and table.watermark() == "w2"


def test_full_publish_replaces_everything(spark, table):
    table.publish_all(frame(spark, [(1, "a")]))
    table.publish_all(frame(spark, [(2, "b")]))
    assert content(table) == [(2, "b")]


def test_same_batch_twice_is_a_no_op(spark, table):
    table.publish_all(frame(spark, [(1, "a")]))
    one = table.publish_changes(frame(spark, [(2, "b")]), ids(spark, 1), feed=("one", 0))
    two = table.publish_changes(frame(spark, [(2, "b")]), ids(spark, 1), feed=("one", 0))
    assert one == two and content(table) == [(2, "b")]


def test_failed_publish_leaves_the_old_version(spark, table):
    table.publish_all(frame(spark, [(1, "a")]), watermark="w1")
    bad = frame(spark, [(2, "b")]).withColumn("text", F.raise_error(F.lit("broken")).cast("string"))
    with pytest.raises(Exception, match="broken"):
        table.publish_all(bad, watermark="w2")
    with pytest.raises(Exception, match="broken"):
        table.publish_changes(bad, ids(spark, 1), watermark="w2")
    assert content(table) == [(1, "a")] and table.watermark() == "w1"


def test_two_writers_cannot_both_commit(spark, table):
    table.publish_all(frame(spark, [(1, "a")]))
    base = table.latest()
    table.publish_all(frame(spark, [(2, "b")]))
    with pytest.raises(FileExistsError):
        table._finish(base, [], None, {})
    assert content(table) == [(2, "b")]


def test_segments_are_merged(spark, table):
    table.publish_all(frame(spark, [(i, "old") for i in range(20)]))
    for i in range(MERGE_AFTER + 1):
        table.publish_changes(frame(spark, [(i, f"v{i}")]), ids(spark, 19 - i))
        assert len(table.latest().segments) <= MERGE_AFTER
    expected = {i: "old" for i in range(20)}
    for i in range(MERGE_AFTER + 1):
        expected.pop(19 - i, None)
        expected[i] = f"v{i}"
    assert content(table) == sorted(expected.items())


def test_a_repeated_batch_is_known_after_other_commits(spark, table):
    table.publish_all(frame(spark, [(1, "a")]))
    table.publish_changes(frame(spark, [(2, "one")]), ids(spark), feed=("one", 0))
    table.publish_changes(frame(spark, [(2, "two")]), ids(spark), feed=("two", 0))
    table.publish_changes(frame(spark, [(2, "late")]), ids(spark), feed=("one", 0))
    assert content(table) == [(1, "a"), (2, "two")]


def test_retention_removes_only_what_no_kept_version_reads(spark, table):
    table.publish_all(frame(spark, [(1, "a"), (2, "b")]))
    for i in range(3):
        table.publish_changes(frame(spark, [(1, f"v{i}")]), ids(spark))
    assert table.retain(1) == 0
    table.publish_all(frame(spark, [(3, "c")]))
    assert table.retain(2) == 0 and content(table) == [(3, "c")]
    assert table.retain(1) == 7 and content(table) == [(3, "c")]
    assert table.run_log().count() == 5


def test_merging_takes_the_smallest_neighbours(spark, table):
    table.publish_all(frame(spark, [(i, "old") for i in range(1000)]))
    base = table.latest().segments[0]["rows"]
    for i in range(3 * MERGE_AFTER):
        table.publish_changes(frame(spark, [(i, "new")]), ids(spark))
    assert table.latest().segments[0]["rows"] == base
    assert table.read().filter("text = 'new'").count() == 3 * MERGE_AFTER and table.read().count() == 1000


def test_files_hold_ranges_of_the_key(spark, table):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        table.publish_all(spark.range(20_000).select("id", F.lit("x").alias("text")).repartition(7))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    path = table.latest().segments[0]["rows"]
    files = spark.read.parquet(path).groupBy(F.input_file_name()).agg(F.min("id").alias("low"), F.max("id").alias("high")).orderBy("low").collect()
    assert len(files) > 1 and all(a.high < b.low for a, b in zip(files, files[1:], strict=False))


def test_drop_and_run_log(spark, table):
    table.publish_all(frame(spark, [(1, "a"), (2, "b"), (3, "c")]), batch_size=2)
    table.publish_changes(frame(spark, [(2, "x")]), ids(spark, 1))
    table.drop()
    assert content(table) == [] and not table.exists()
    log = table.run_log().orderBy("commit").collect()
    assert [(r.total_rows, r.total_batches, r.mode, r.status) for r in log[:2]] == [
        (3, 2, "full", "success"), (1, 1, "incremental", "success"),
    ]
    assert log[1].removed_ids == 2 and log[2].mode == "drop"


def test_report_and_stale_ids(spark):
    assert run_report(0, 25, "full")["total_batches"] == 0
    assert run_report(51, 25, "full")["total_batches"] == 3
    got = stale_ids(ids(spark, 1, 1, 2), ids(spark, 2, 3), "id")
    assert sorted(r.id for r in got.collect()) == [1, 2, 3]


def test_runs(spark, tmp_path):
    table = snapshot_table(spark, str(tmp_path / "snap"), SETTINGS)
    catalog = small_catalog(spark)
    report = run(catalog, table, SETTINGS, now="2024-01-10 00:00:00")
    assert report == {"total_rows": 15, "total_batches": 1, "mode": "full", "status": "success"}
    assert table.watermark() == "2024-01-10 00:00:00"
    assert {len(r.embedding) for r in table.read().select("embedding").collect()} == {8}

    # Nothing changed: skipped, nothing written, watermark kept.
    skipped = run(catalog, table, SETTINGS, now="2024-01-11 00:00:00")
    assert skipped["status"] == "skipped" and table.watermark() == "2024-01-10 00:00:00"
    assert [r.status for r in table.run_log().orderBy("commit").collect()] == ["success", "skipped"]
    assert run(catalog, table, SETTINGS, now="2024-01-10 00:00:00", full=True)["mode"] == "full"

    # One service renamed, one deleted, one of unknown status left as it was.
    services = [dict(row) for row in ROWS["services"]]
    for row in services:
        if row["id"] == 1:
            row.update(name="Suppers", updated_at=LATE)
        if row["id"] == 2:
            row.update(status=0, updated_at=LATE)
    later = small_catalog(spark, services=services)
    report = run(later, table, SETTINGS, now="2024-02-10 00:00:00")
    assert (report["total_rows"], report["removed_ids"], report["status"]) == (8, 2, "success")
    plain = ["snapshot_key", "service_id", "address_id", "embedding_text"]
    assert rows_of(table.read().select(plain)) == rows_of(build_snapshot(later).select(plain))

    # Only a delete: rows go, nothing is embedded.
    for row in services:
        if row["id"] == 6:
            row.update(status=0, updated_at=LATE.replace(month=3))
    report = run(small_catalog(spark, services=services), table, SETTINGS, now="2024-03-10 00:00:00")
    assert report["total_rows"] == 0 and table.read().filter("service_id = 6").isEmpty()


def test_scratch_folder_follows_the_session(spark):
    shared = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert scratch_root(spark).startswith(shared) and scratch_root(spark) != scratch_root(spark)


def test_command_line(spark, tmp_path, capsys):
    import json

    from snapwright.__main__ import main

    catalog = small_catalog(spark)
    for name in catalog.names():
        catalog[name].write.parquet(f"{tmp_path}/source/{name}")
    given = ["--source", f"{tmp_path}/source", "--target", f"{tmp_path}/target", "--dimension", "8"]
    assert main(given)["mode"] == "full"
    assert main(given)["status"] == "skipped"
    first, second = [json.loads(line) for line in capsys.readouterr().out.strip().splitlines()]
    assert first["total_rows"] == 15 and second["table"] == f"{tmp_path}/target"


def test_what_finish_adds_is_made_once_per_row_as_rows_are_written(spark, table, monkeypatch):
    from snapwright.sources import published

    held, keep, made = [], published.stored, spark.sparkContext.accumulator(0)
    monkeypatch.setattr(published, "stored", lambda df, name: held.append(df.columns) or keep(df, name))

    @F.udf("string")
    def text(i):
        made.add(1)
        return f"t{i}"

    ids = spark.range(200).repartition(5)
    commit = table.publish_all(ids, finish=lambda rows: rows.withColumn("text", text.asNondeterministic()("id")))
    assert held == [["id"]] and made.value == 200 and commit.report["total_rows"] == 200
    table.publish_changes(ids.filter("id < 3"), ids.filter("id = 9"), finish=lambda rows: rows.withColumn("text", F.lit("new")))
    assert {r.id: r.text for r in table.read().collect()} == {i: "new" if i < 3 else f"t{i}" for i in range(200) if i != 9}


def test_each_published_query_shows_the_tables_as_they_are(spark, tmp_path, sf_dir):
    import os

    from snapwright.plans.queries import QUERIES

    folder = tmp_path / "tables"
    folder.mkdir()
    for name in os.listdir(sf_dir):
        os.symlink(f"{sf_dir}/{name}", folder / name)
    before = QUERIES["geo_box"](spark, str(folder)).count()
    os.remove(folder / "part.parquet")
    spark.read.parquet(f"{sf_dir}/part.parquet").filter("p_partkey < 20").write.parquet(str(folder / "part.parquet"))
    assert QUERIES["geo_box"](spark, str(folder)).count() < before


def test_many_replaced_ids_are_not_sent_to_every_task(spark, table, monkeypatch):
    from snapwright.sources import published

    monkeypatch.setattr(published, "BROADCAST_ROWS", 3)
    plan = lambda: table.read()._jdf.queryExecution().executedPlan().toString()
    table.publish_all(frame(spark, [(i, "old") for i in range(9)]))
    table.publish_changes(frame(spark, [(1, "new")]), ids(spark, 2))
    assert "BroadcastHashJoin" in plan() and table.latest().segments[1]["gone"] == 2
    table.publish_changes(frame(spark, [(3, "new")]), ids(spark, 4))
    assert "SortMergeJoin" in plan() and "Broadcast" not in plan()
    assert content(table) == [(0, "old"), (1, "new"), (3, "new"), *[(i, "old") for i in range(5, 9)]]
    for i in range(MERGE_AFTER):
        table.publish_changes(frame(spark, [(5, f"turn {i}")]), ids(spark))
    assert len(table.latest().segments) == MERGE_AFTER and all(s["gone"] for s in table.latest().segments[1:])
    assert content(table)[3:5] == [(5, f"turn {MERGE_AFTER - 1}"), (6, "old")]
