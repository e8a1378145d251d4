"""The table of the newest events, late rows and recorded progress over several micro-batches."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from depotlake.config import conf
from depotlake.sources import read_table_stream
from depotlake.streaming import (
    ProgressTable,
    dedup_stream,
    finished_batches,
    keep_late_rows,
    latest_table_stream,
    merge_latest,
    progress_totals,
    read_derived,
    read_latest,
    read_progress,
    run_stream,
)
from tests.helpers import rows

EVENTS = "id string, at timestamp, seen timestamp, state string"
T = datetime(2025, 1, 1)


def minutes(n):
    return T + timedelta(minutes=n)


class Steps:
    def __init__(self, spark, path):
        self.spark, self.path = spark, str(path)
        path.mkdir()

    def land(self, *events):
        frame = self.spark.createDataFrame([(i, minutes(at), minutes(seen), state) for i, at, seen, state in events], EVENTS)
        frame.coalesce(1).write.mode("append").parquet(self.path)

    def stream(self, max_files=None):
        return read_table_stream(self.spark, self.path, self.spark.createDataFrame([], EVENTS).schema, max_files)


@pytest.fixture
def steps(spark, tmp_path):
    return Steps(spark, tmp_path / "steps")


def test_one_row_per_key_whatever_the_order(spark, steps, tmp_path):
    out, checkpoint = f"{tmp_path}/out", f"{tmp_path}/cp"
    schema = spark.createDataFrame([], EVENTS).schema

    def run():
        latest_table_stream(steps.stream(), out, checkpoint, ["id"], ["at", "seen"], buckets=3).awaitTermination()
        found = read_latest(spark, out, schema)
        assert found.count() == found.select("id").distinct().count()
        return {r.id: r.state for r in found.collect()}

    assert rows(read_latest(spark, out, schema)) == []
    steps.land(("a", 5, 5, "new"), ("b", 1, 1, "b1"), ("c", 1, 1, "c1"))
    assert run() == {"a": "new", "b": "b1", "c": "c1"}
    steps.land(("a", 3, 9, "older, later seen"), ("b", 2, 2, "b2"), ("d", 1, 1, "d1"))
    assert run() == {"a": "new", "b": "b2", "c": "c1", "d": "d1"}
    assert run() == {"a": "new", "b": "b2", "c": "c1", "d": "d1"}  # nothing came
    steps.land(("a", 5, 5, "tie"), ("a", 5, 6, "seen last"), ("e", 0, 0, None))
    assert run()["a"] == "seen last"
    for k in range(4):
        steps.land(("a", 20 + k, 20, f"step {k}"))
        assert run()["a"] == f"step {k}" and run()["c"] == "c1"
    # Of each bucket two versions stay, however many micro-batches there were.
    kept = [p.parent.name + p.name for p in (tmp_path / "out").glob("version=*/bucket=*")]
    assert len(kept) <= 2 * 3


def test_a_version_without_its_mark_is_not_read_and_repeats_replace(spark, tmp_path):
    out = f"{tmp_path}/out"
    frame = lambda *e: spark.createDataFrame([(i, minutes(at), minutes(at), s) for i, at, s in e], EVENTS)
    merge_latest(frame(("a", 1, "a1"), ("b", 1, "b1")), 0, out, ["id"], ["at"], 2)
    merge_latest(frame(("a", 2, "a2")), 1, out, ["id"], ["at"], 2)
    schema = frame(("a", 1, "")).schema
    state = lambda: {r.id: r.state for r in read_latest(spark, out, schema).collect()}
    assert state() == {"a": "a2", "b": "b1"}
    (tmp_path / "out" / "version=000000000001" / "_SUCCESS").unlink()
    assert state() == {"a": "a1", "b": "b1"}
    for _ in range(2):
        merge_latest(frame(("a", 2, "a2")), 1, out, ["id"], ["at"], 2)
        assert state() == {"a": "a2", "b": "b1"}


def test_derived_tables_lose_rows_as_well(spark, tmp_path):
    out, derived = f"{tmp_path}/out", f"{tmp_path}/open"
    frame = lambda *e: spark.createDataFrame([(i, minutes(at), minutes(at), s) for i, at, s in e], EVENTS)
    schema = frame(("a", 1, "")).schema
    is_open = {derived: lambda rows: rows.where("state = 'open'")}
    merge_latest(frame(("a", 1, "open"), ("b", 1, "open")), 0, out, ["id"], ["at"], 4, is_open)
    merge_latest(frame(("a", 2, "closed")), 1, out, ["id"], ["at"], 4, is_open)
    assert rows(read_derived(spark, derived, schema).select("id")) == [("b",)]


@pytest.mark.parametrize("mode", ["first", "within_watermark"])
def test_late_rows_are_those_the_stream_dropped(spark, steps, tmp_path, mode):
    out, late, checkpoint = (f"{tmp_path}/{n}" for n in ("out", "late", "cp"))
    progress = ProgressTable(spark, f"{tmp_path}/progress")
    spark.streams.addListener(progress)

    def run(max_files=None):
        stream = dedup_stream(steps.stream(max_files), ["id"], mode, "at", "5 minutes")
        query = run_stream(stream, out, checkpoint, name="dedup")
        query.awaitTermination()
        progress.wait_for(query)

    read = lambda files: spark.read.schema(EVENTS).parquet(*files)
    steps.land(("a", 60, 0, ""), ("b", 1, 0, "late to its own batch only"))
    run()
    assert keep_late_rows(spark, checkpoint, late, read, "at") == [0]
    steps.land(("c", 55, 0, "at the watermark"), ("d", 56, 0, ""), ("e", 2, 0, "late"), ("f", 120, 0, ""))
    run()
    # Two micro-batches back to back: the second still has the watermark from before the first.
    steps.land(("g", 300, 0, ""), ("h", 100, 0, "late"))
    steps.land(("i", 200, 0, "on time, the mark moves a batch later"), ("j", 3, 0, "late"))
    run(max_files=1)
    steps.land(("k", 290, 0, "late"), ("k", 296, 0, ""))
    run()
    taken = keep_late_rows(spark, checkpoint, late, read, "at")
    assert len(taken) == 4 and keep_late_rows(spark, checkpoint, late, read, "at") == []
    spark.streams.removeListener(progress)
    kept = spark.read.schema(EVENTS).parquet(out)
    dropped = spark.read.schema(EVENTS).parquet(late)
    assert kept.count() + dropped.count() == 12
    totals = progress_totals(spark, f"{tmp_path}/progress").first()
    assert totals.rows_dropped_late == dropped.count() and totals.input_rows == 12 and totals.name == "dedup"
    assert {r.id for r in dropped.collect()} >= {"c", "e", "h", "j", "k"} and "b" not in {r.id for r in dropped.collect()}


def test_lost_batches_are_an_error(spark, steps, tmp_path):
    steps.land(("a", 60, 0, ""))
    run_stream(dedup_stream(steps.stream(), ["id"], "first", "at"), f"{tmp_path}/out", f"{tmp_path}/cp").awaitTermination()
    assert [b.number for b in finished_batches(spark, f"{tmp_path}/cp")][0] == 0
    (tmp_path / "cp" / "offsets" / "0").unlink()
    with pytest.raises(RuntimeError, match="no longer in the log"):
        finished_batches(spark, f"{tmp_path}/cp")


def test_progress_beyond_what_spark_remembers(spark, steps, tmp_path):
    for k in range(6):
        steps.land((f"s{k}", k, k, ""), ("again", k, k, ""))
    progress = ProgressTable(spark, f"{tmp_path}/progress")
    assert read_progress(spark, f"{tmp_path}/progress").count() == 0
    spark.streams.addListener(progress)
    with conf(spark, spark__sql__streaming__numRecentProgressUpdates="2"):
        query = run_stream(steps.stream(1), f"{tmp_path}/out", f"{tmp_path}/cp", name="long")
        query.awaitTermination()
    progress.wait_for(query)
    spark.streams.removeListener(progress)
    assert sum(p.numInputRows for p in query.recentProgress) < 12
    (totals,) = progress_totals(spark, f"{tmp_path}/progress").where(F.col("name") == "long").collect()
    assert (totals.input_rows, totals.batches >= 6) == (12, True)


def test_batches_that_change_nothing_write_nothing(spark, tmp_path):
    """Older, equal and repeated events: neither their buckets nor what is derived from them is made again."""
    out, derived = f"{tmp_path}/out", f"{tmp_path}/all"
    frame = lambda *e: spark.createDataFrame([(i, minutes(at), minutes(at), s) for i, at, s in e], EVENTS)
    schema = frame(("a", 1, "")).schema
    versions = lambda folder: sorted(p.parent.name[-1] + p.name[-1] for p in folder.glob("version=*/bucket=*"))
    merge = lambda version, *events: merge_latest(frame(*events), version, out, ["id"], ["at"], 4, {derived: lambda rows: rows})
    many = [(f"k{i}", 5, "first") for i in range(20)]
    merge(0, *many)
    before = versions(tmp_path / "out")
    assert len(before) == 4
    merge(1, *((i, 3, "older") for i, _, _ in many), *many[:3], (None, 1, "no key"))
    # The row without a key is new, and its bucket is the only one with a second version.
    assert len(versions(tmp_path / "out")) == len(versions(tmp_path / "all")) == 5
    merge(2, *many, ("k7", 6, "newer"))
    assert len(versions(tmp_path / "out")) == len(versions(tmp_path / "all")) <= 6
    expected = sorted([(i, "newer" if i == "k7" else "first") for i, _, _ in many] + [(None, "no key")], key=str)
    for found in (read_latest(spark, out, schema), read_derived(spark, derived, schema)):
        assert sorted(((r.id, r.state) for r in found.collect()), key=str) == expected


def test_a_batch_arrives_in_a_file_for_each_bucket(spark, steps, tmp_path, monkeypatch):
    """Streams run without adaptive execution, where every task of the aggregation wrote a file for each bucket."""
    from depotlake.streaming import latest

    files = []
    monkeypatch.setattr(latest, "delete_paths", lambda _, paths: files.extend(tmp_path.glob("out/_arrived/*/bucket=*/*.parquet")))
    steps.land(*((f"k{i}", i, i, "") for i in range(200)))
    latest_table_stream(steps.stream(), f"{tmp_path}/out", f"{tmp_path}/cp", ["id"], ["at", "seen"], buckets=3).awaitTermination()
    written = list(tmp_path.glob("out/version=*/bucket=*/*.parquet"))
    assert len(files) == 3 and len(written) == 3


def test_a_derived_table_has_room_for_its_former_version_only(spark, tmp_path, monkeypatch):
    """Each version is as large as the table: a third one beside the two that stay was the most the disk had to hold."""
    from depotlake.streaming import latest

    out, derived = f"{tmp_path}/out", tmp_path / "all"
    frame = lambda state: spark.createDataFrame([(f"k{i}", minutes(state), T, str(state)) for i in range(20)], EVENTS)
    schema = frame(0).schema
    there, write = [], latest.write_version_in_place

    def watched(*args):
        there.append(len(list(derived.glob("version=*/bucket=*/"))))
        write(*args)

    monkeypatch.setattr(latest, "write_version_in_place", watched)
    for version in [0, 1, 2, 3, 3, 4]:
        merge_latest(frame(version), version, out, ["id"], ["at"], 4, {str(derived): lambda rows: rows})
        assert {r.state for r in read_derived(spark, str(derived), schema).collect()} == {str(version)}
        assert read_derived(spark, str(derived), schema).count() == 20
    # Version 3 came twice, and the write deletes what it left first.
    assert there == [0, 4, 4, 4, 8, 4]


def test_derived_rows_are_written_where_they_are_made(spark, tmp_path):
    """Pairs are many times the rows they are made of: no shuffle by buckets, no sort, and few tasks, each with a file for each bucket."""
    out, derived = f"{tmp_path}/out", tmp_path / "pairs"
    batch = spark.createDataFrame([(f"k{i}", T, T, "") for i in range(40)], EVENTS)
    pairs = lambda rows: rows.repartition(50).crossJoin(spark.range(30).withColumnRenamed("id", "n"))
    merge_latest(batch, 0, out, ["id"], ["at"], 4, {str(derived): pairs})
    files = list(derived.glob("version=*/bucket=*/*.parquet"))
    tasks = {f.name.split("-")[1] for f in files}
    assert len(tasks) <= 4 * spark.sparkContext.defaultParallelism < 50 and len(files) > 4
    schema = pairs(batch).schema
    assert read_derived(spark, str(derived), schema).count() == read_derived(spark, str(derived), schema).distinct().count() == 40 * 30


def test_a_writer_for_each_bucket_stays_open(spark, tmp_path, monkeypatch):
    """With as many writers as it may keep, Spark sorts the rest of a task's rows: all pairs, by buckets."""
    from depotlake.sinks import versions

    kept = []
    monkeypatch.setattr(versions, "conf", lambda session, **settings: kept.append(settings) or conf(session, **settings))
    rows_of = spark.range(0, 3_000, 1, 2).withColumn("bucket", (F.col("id") % 3).cast("int"))
    versions.write_version_in_place(rows_of, f"{tmp_path}/out", 0, 3)
    assert [int(s["spark__sql__maxConcurrentOutputFileWriters"]) for s in kept] == [4]
    assert spark.read.parquet(f"{tmp_path}/out").count() == 3_000


def test_a_micro_batch_leaves_no_shuffle_files(spark, steps, tmp_path):
    """They stayed until the driver collected garbage, those of all micro-batches together."""
    spark._jvm.System.gc()
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        files = manager.getAllFiles()
        found = [files.apply(k) for k in range(files.size())]
        return sum(f.length() for f in found if f.getName().startswith("shuffle_"))

    def derive(rows):
        many = rows.crossJoin(spark.range(2_000).withColumnRenamed("id", "n"))
        return many.select("id", "n", F.sha2(F.concat("id", F.lit("/"), F.col("n").cast("string")), 256).alias("text")).repartition("n")

    before = shuffled()
    steps.land(*((f"k{i}", i, i, "") for i in range(200)))
    latest_table_stream(
        steps.stream(), f"{tmp_path}/out", f"{tmp_path}/cp", ["id"], ["at", "seen"], buckets=3, derived={f"{tmp_path}/d": derive}
    ).awaitTermination()
    # Those of the stream's own aggregation, a row for each event, may stay.
    assert shuffled() - before < 1_000_000
    assert read_derived(spark, f"{tmp_path}/d", spark.createDataFrame([], "id string, n long, text string").schema).distinct().count() == 400_000
