import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from depotlake.plans import silver
from depotlake.schemas import BRONZE_SHIPMENTS, SILVER_SHIPMENTS
from depotlake.sources import read_event_files, read_table_stream
from depotlake.streaming import (
    bronze_shipments,
    compact_latest_state,
    dedup_stream,
    latest_state,
    latest_state_stream,
    run_stream,
    silver_shipments_stream,
    stream_report,
)
from tests.conftest import RUN_TS
from tests.helpers import rows


def event(shipment="SH1", warehouse="WH1", status="In Transit", location="mumbai", hour=1, **more):
    return {
        "shipment_id": shipment,
        "warehouse_id": warehouse,
        "status": status,
        "location": location,
        "timestamp": f"2025-08-31T{hour:02d}:00:00Z",
        **more,
    }


class Landing:
    """A landing folder with one pretty-printed event per file, as the producer writes it."""

    def __init__(self, path):
        self.path, self.n = path, 0

    def drop(self, *events, day="20250831"):
        for e in events:
            folder = self.path / day
            folder.mkdir(parents=True, exist_ok=True)
            self.n += 1
            text = e if isinstance(e, str) else json.dumps(e, indent=2)
            (folder / f"shipment_{self.n:04d}.json").write_text(text)


@pytest.fixture
def landing(tmp_path):
    return Landing(tmp_path / "landing")


# --- parsing -----------------------------------------------------------------------------


@pytest.mark.parametrize("multiline", [True, False])
def test_event_files_drift_and_corruption(spark, landing, multiline):
    indent = 2 if multiline else None
    landing.drop(
        json.dumps(event(carrier="road", nested={"a": 1}), indent=indent),
        json.dumps(event("SH2", delay_reason=None), indent=indent),
        json.dumps({**event("SH3"), "status": 7, "location": ["x", 1]}, indent=indent),
        '{"shipment_id": "SH4", "status": ',
        "",
        json.dumps([event("SH5"), event("SH6")], indent=indent),
    )
    df = read_event_files(spark, str(landing.path), multiline=multiline)
    found = {r.shipment_id: r for r in df.collect()}
    assert set(found) == {"SH1", "SH2", "SH3", "SH4", "SH5", "SH6"} or set(found) == {
        "SH1", "SH2", "SH3", None, "SH5", "SH6"
    }
    assert json.loads(found["SH1"]._rescued_data) == {"carrier": "road", "nested": '{"a":1}'}
    assert found["SH2"]._rescued_data is None and found["SH5"]._rescued_data is None
    assert (found["SH3"].status, found["SH3"].location) == ("7", '["x",1]')
    (broken,) = [r for r in df.collect() if r._rescued_data and r._rescued_data.startswith('{"shipment_id"')]
    assert broken._rescued_data == '{"shipment_id": "SH4", "status": '
    assert found["SH1"].source_file.endswith("20250831/shipment_0001.json")


# --- bronze ------------------------------------------------------------------------------


def run_bronze(spark, landing, tmp_path, **options):
    rows_ = bronze_shipments(spark, str(landing.path), run_ts=RUN_TS, **options)
    query = run_stream(rows_, f"{tmp_path}/bronze", f"{tmp_path}/cp_bronze", name="bronze")
    query.awaitTermination()
    return query


def test_bronze_stream_takes_each_file_once_across_restarts(spark, landing, tmp_path):
    landing.drop(event(), event("SH2"))
    run_bronze(spark, landing, tmp_path)
    run_bronze(spark, landing, tmp_path)  # nothing new
    landing.drop(event("SH3", extra=1), day="20250901")
    query = run_bronze(spark, landing, tmp_path, max_files=1)
    bronze = spark.read.schema(BRONZE_SHIPMENTS).parquet(f"{tmp_path}/bronze")
    assert rows(bronze.select("shipment_id", "_rescued_data", "ingestion_time", "source_system")) == [
        ("SH1", None, RUN_TS, "TMS_live"),
        ("SH2", None, RUN_TS, "TMS_live"),
        ("SH3", '{"extra":"1"}', RUN_TS, "TMS_live"),
    ]
    report = stream_report(spark, [query]).collect()[0]
    assert (report.name, report.is_active, report.recent_input_rows) == ("bronze", False, 1)
    assert stream_report(spark).count() == 0


def test_stream_and_batch_give_the_same_silver(spark, landing, tmp_path):
    landing.drop(
        event(location="12.5,77.25", status=" DELAYED "),
        event("SH2", "whx"),
        event("SH3", "wh3", location=" new delhi ", status="lost"),
    )
    run_bronze(spark, landing, tmp_path)
    now = F.lit(RUN_TS).cast("timestamp")
    stream = silver_shipments_stream(
        read_table_stream(spark, f"{tmp_path}/bronze", BRONZE_SHIPMENTS), "first", run_ts=now
    )
    run_stream(stream, f"{tmp_path}/silver", f"{tmp_path}/cp", partition_by=["warehouse_id"]).awaitTermination()
    streamed = spark.read.schema(SILVER_SHIPMENTS).parquet(f"{tmp_path}/silver").select(SILVER_SHIPMENTS.fieldNames())
    bronze = spark.read.schema(BRONZE_SHIPMENTS).parquet(f"{tmp_path}/bronze")
    batch = silver.silver_shipments(bronze, RUN_TS).select(SILVER_SHIPMENTS.fieldNames())
    assert rows(streamed) == rows(batch)
    assert {p.name for p in (tmp_path / "silver").iterdir() if p.name.startswith("warehouse")} == {
        "warehouse_id=WH1",
        "warehouse_id=WH3",
    }


# --- deduplication -----------------------------------------------------------------------


START = datetime(2025, 8, 31, 12)


class Batches:
    """A Parquet folder read as a stream, one micro-batch per call."""

    def __init__(self, spark, tmp_path, build):
        self.spark, self.path, self.build = spark, tmp_path, build
        self.schema = "shipment_id string, warehouse_id string, status string, ingestion_time timestamp"

    def send(self, *events):
        found = [(s, w, st, START + timedelta(minutes=m)) for s, w, st, m in events]
        df = self.spark.createDataFrame(found, self.schema)
        df.coalesce(1).write.mode("append").parquet(f"{self.path}/in")
        stream = read_table_stream(self.spark, f"{self.path}/in", df.schema)
        self.query = run_stream(self.build(stream), f"{self.path}/out", f"{self.path}/cp")
        self.query.awaitTermination()

    def statuses(self):
        return rows(self.spark.read.parquet(f"{self.path}/out").select("shipment_id", "status"))


def test_first_keeps_the_first_event_for_good(spark, tmp_path):
    b = Batches(spark, tmp_path, lambda df: dedup_stream(df, ["shipment_id"], "first"))
    b.send(("A", "WH1", "first", 0), ("A", "WH1", "first", 0))
    b.send(("A", "WH1", "second", 1), ("B", "WH1", "first", 60))
    b.send(("A", "WH1", "third", 90))
    assert b.statuses() == [("A", "first"), ("B", "first")]


def test_within_watermark_forgets_and_drops_late_rows(spark, tmp_path):
    b = Batches(spark, tmp_path, lambda df: dedup_stream(df, ["shipment_id"], "within_watermark"))
    b.send(("A", "WH1", "first", 0))
    b.send(("A", "WH1", "repeat", 1), ("B", "WH1", "first", 60))
    b.send(("A", "WH1", "back", 61), ("C", "WH1", "late", 0))
    assert b.statuses() == [("A", "back"), ("A", "first"), ("B", "first")]
    report = stream_report(spark, [b.query]).collect()[0]
    assert report.recent_rows_dropped_late == 1


def test_none_keeps_everything_and_unknown_modes_fail(spark, tmp_path):
    b = Batches(spark, tmp_path, lambda df: dedup_stream(df, ["shipment_id"], "none"))
    b.send(("A", "WH1", "x", 0), ("A", "WH1", "x", 0))
    assert len(b.statuses()) == 2
    with pytest.raises(ValueError):
        dedup_stream(spark.range(1), ["id"], "last")


@pytest.mark.parametrize("parity, expected", [(False, [("SH1", "Delayed")]), (True, [])])
def test_invalid_first_event(spark, landing, tmp_path, parity, expected):
    landing.drop(event(warehouse="oops"))
    run_bronze(spark, landing, tmp_path)

    def run():
        source = read_table_stream(spark, f"{tmp_path}/bronze", BRONZE_SHIPMENTS)
        stream = silver_shipments_stream(source, "first", parity)
        run_stream(stream, f"{tmp_path}/silver", f"{tmp_path}/cp").awaitTermination()

    run()
    landing.drop(event(status="delayed", hour=2))
    run_bronze(spark, landing, tmp_path)
    run()
    found = spark.read.schema(SILVER_SHIPMENTS).parquet(f"{tmp_path}/silver")
    assert rows(found.select("shipment_id", "status")) == expected


# --- latest state ------------------------------------------------------------------------


def test_latest_state_follows_the_newest_event(spark, landing, tmp_path):
    out = f"{tmp_path}/state"

    def run():
        run_bronze(spark, landing, tmp_path)
        source = read_table_stream(spark, f"{tmp_path}/bronze", BRONZE_SHIPMENTS)
        latest_state_stream(silver_shipments_stream(source, "none"), out, f"{tmp_path}/cp").awaitTermination()
        return rows(latest_state(spark, out, SILVER_SHIPMENTS).select("shipment_id", "status"))

    assert rows(latest_state(spark, out, SILVER_SHIPMENTS)) == []
    landing.drop(event(hour=1), event(status="delayed", hour=3), event("SH2", hour=1))
    assert run() == [("SH1", "Delayed"), ("SH2", "In Transit")]
    landing.drop(event(status="delivered", hour=2), event("SH2", status="delivered", hour=2))  # SH1 arrives late
    assert run() == [("SH1", "Delayed"), ("SH2", "Delivered")]
    compact_latest_state(spark, out, SILVER_SHIPMENTS)
    assert [p.name.split("-")[0] for p in (tmp_path / "state").iterdir()] == ["batch=compacted"]
    landing.drop(event("SH3", status="delivered", hour=2), event(status="delivered", hour=4))
    assert run() == [("SH1", "Delivered"), ("SH2", "Delivered"), ("SH3", "Delivered")]
