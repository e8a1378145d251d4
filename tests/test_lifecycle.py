import json
from datetime import date, timedelta

import pytest

from depotlake.config import Layout, dated_name, dated_path, scratch_dir
from depotlake.plans import lifecycle, run
from depotlake.schemas import GOLD
from depotlake.sources import delete_paths, list_files, path_exists, read_csv_text, read_file_mapping
from depotlake.streaming import stream_report
from tests.conftest import AS_OF, RUN_TS
from tests.helpers import column, rows

MAPPING = [
    {"filenamePrefix": "inventory_", "sinkFolder": "inventory"},
    {"filenamePrefix": "salesorder_", "sinkFolder": "salesorder"},
]


@pytest.fixture
def mapping(spark, tmp_path):
    (tmp_path / "fileMapping.json").write_text(json.dumps(MAPPING, indent=2))
    return read_file_mapping(spark, f"{tmp_path}/fileMapping.json")


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


def test_dated_names():
    assert dated_name("inventory_", AS_OF) == "inventory_20250831.csv"
    assert dated_path("/b", "salesorder_", AS_OF) == "/b/salesorder_20250831.csv"


def test_scratch_follows_the_session(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert first.startswith(root) and first != second


def test_file_mapping(mapping):
    assert rows(mapping) == [("inventory_", "inventory"), ("salesorder_", "salesorder")]


def test_list_files(spark, tmp_path):
    write(tmp_path / "20250828" / "a.json", "{}")
    write(tmp_path / "notadate" / "b.json", "{}")
    write(tmp_path / "inventory_20250831.csv" / "part-0.csv", "a\n1\n")
    write(tmp_path / "inventory_20250831.csv" / "part-1.csv", "a\n2\n")
    listed = list_files(spark, str(tmp_path))
    assert rows(listed.select("file_name", "folder_date").distinct()) == [
        ("a.json", date(2025, 8, 28)),
        ("b.json", None),
        ("inventory_20250831.csv", None),
    ]
    assert "content" not in listed.columns
    assert list_files(spark, f"{tmp_path}/nowhere").count() == 0
    assert column(list_files(spark, str(tmp_path), "b*"), "file_name") == ["b.json"]


def test_ingest_waits_for_every_file_and_copies_only_its_own(spark, tmp_path, mapping):
    landing, bronze = tmp_path / "landing", f"{tmp_path}/bronze"
    write(landing / "inventory_20250831.csv", 'a,b\n1,"x, y"\n,z\n')
    write(landing / "inventory_20250830.csv", "a,b\n9,old\n")
    with pytest.raises(FileNotFoundError, match="salesorder_20250831.csv"):
        lifecycle.ingest_landing(spark, str(landing), mapping, AS_OF, bronze)
    assert not path_exists(spark, bronze)
    write(landing / "salesorder_20250831.csv", "c\n3\n")
    written = lifecycle.ingest_landing(spark, str(landing), mapping, AS_OF, bronze)
    assert written["inventory_20250831.csv"] == f"{bronze}/inventory/inventory_20250831.csv"
    copied = read_csv_text(spark, written["inventory_20250831.csv"])
    assert rows(copied) == [(None, "z"), ("1", "x, y")]
    parts = (tmp_path / "bronze" / "inventory" / "inventory_20250831.csv").glob("part*")
    assert any('"1","x, y"' in p.read_text() for p in parts)
    assert rows(read_csv_text(spark, written["salesorder_20250831.csv"])) == [("3",)]


def test_archive_events_by_age_once_and_purge(spark, tmp_path):
    landing, dest = tmp_path / "landing", f"{tmp_path}/archive"
    text = json.dumps({"shipment_id": "SH1", "note": "é"}, indent=2)
    write(landing / "20250827" / "a.json", text)
    write(landing / "20250827" / "broken.json", '{"shipment_id"')
    write(landing / "20250828" / "edge.json", text)  # exactly three days: stays
    write(landing / "20250830" / "new.json", text)
    write(landing / "notadate" / "x.json", text)
    run_once = lambda **o: lifecycle.archive_events(spark, str(landing), dest, AS_OF, **o)
    assert rows(run_once()) == [(date(2025, 8, 27), 2, 2)]
    assert rows(run_once()) == []  # nothing new, nothing read
    archive = lifecycle.read_archive(spark, dest)
    assert sorted(column(archive, "value")) == sorted([text, '{"shipment_id"'])
    assert (landing / "20250827").exists()
    assert rows(run_once(purge=True)) == [(date(2025, 8, 27), 2, 2)]
    left = {p.name for p in landing.iterdir() if any(p.glob("*.json"))}
    assert left == {"20250828", "20250830", "notadate"}
    # A file that arrives after its day was archived joins the archive.
    write(landing / "20250827" / "late.json", "{}")
    assert rows(run_once(purge=True)) == [(date(2025, 8, 27), 1, 1)]
    assert lifecycle.read_archive(spark, dest).count() == 3
    assert run_once().count() == 0


def test_archive_purges_thousands_of_files_without_reading_them_again(spark, tmp_path, monkeypatch):
    landing, dest = tmp_path / "landing", f"{tmp_path}/archive"
    for k in range(2_000):
        write(landing / f"202508{k % 20 + 1:02d}" / f"e {k}.json", json.dumps({"n": k}))
    report = lifecycle.archive_events(spark, str(landing), dest, AS_OF)
    assert sum(r.rows_archived for r in report.collect()) == 2_000
    # Changed since: neither deleted nor taken for the copy. Reading any text now would fail.
    write(landing / "20250803" / "e 2.json", '{"n": "changed"}')
    monkeypatch.setattr(type(spark.read), "text", lambda *a, **k: pytest.fail("a text is read again"))
    lifecycle.archive_events(spark, str(landing), dest, AS_OF, purge=True)
    assert [p.name for p in landing.rglob("*.json")] == ["e 2.json"]


def test_a_lost_archive_run_is_no_part_of_the_archive(spark, tmp_path):
    landing, dest = tmp_path / "landing", f"{tmp_path}/archive"
    write(landing / "20250801" / "a.json", "one")
    spark.createDataFrame([("x", "left behind", 1)], "file_path STRING, value STRING, digest BIGINT").write.json(f"{dest}/run=lost")
    assert lifecycle.read_archive(spark, dest).count() == 0
    lifecycle.archive_events(spark, str(landing), dest, AS_OF)
    assert column(lifecycle.read_archive(spark, dest), "value") == ["one"]


def test_archive_events_takes_nested_files_and_leaves_what_it_has_not_archived(spark, tmp_path):
    landing, dest = tmp_path / "20240101" / "landing", f"{tmp_path}/archive"
    write(landing / "20250801" / "a.json", "one")
    write(landing / "20250801" / "sub dir" / "c.json", "two\nlines")
    write(landing / "20250801" / "b.txt", "foreign")
    report = lifecycle.archive_events(spark, str(landing), dest, AS_OF, purge=True)
    assert rows(report) == [(date(2025, 8, 1), 2, 2)]
    assert sorted(column(lifecycle.read_archive(spark, dest), "value")) == ["one", "two\nlines"]
    assert [p.name for p in (landing / "20250801").rglob("*") if p.is_file() and not p.name.startswith(".")] == ["b.txt"]


def test_archive_batch_with_line_breaks_and_overlapping_prefixes(spark, tmp_path):
    landing, dest = tmp_path / "landing", f"{tmp_path}/archive"
    write(landing / "inventory_20250831.csv", 'a,b\n1,"two\nlines"\n')
    write(landing / "inventory_x_20250831.csv", "a\n1\n")
    write(landing / "sub" / "inventory_20250831.csv", "a\n9\n")
    prefixes = [("inventory", "one"), ("inventory_x", "two")]
    mapping = spark.createDataFrame(prefixes, "filenamePrefix STRING, sinkFolder STRING")
    written = lifecycle.archive_batch(spark, str(landing), mapping, dest, AS_OF, purge=True)
    assert [w.removeprefix(f"{dest}/20250831") for w in written] == [
        "/one/inventory_20250831.csv",
        "/two/inventory_x_20250831.csv",
    ]
    assert rows(read_csv_text(spark, written[0])) == [("1", "two\nlines")]
    assert [p.name for p in landing.rglob("*.csv")] == ["inventory_20250831.csv"]


def test_a_file_in_a_subfolder_has_not_arrived(spark, tmp_path, mapping):
    write(tmp_path / "sub" / "inventory_20250831.csv", "a\n1\n")
    assert not any(column(lifecycle.arrivals(spark, str(tmp_path), mapping, AS_OF), "is_present"))


def test_archive_batch_keeps_files_apart(spark, tmp_path, mapping):
    landing, dest = tmp_path / "landing", f"{tmp_path}/archive"
    write(landing / "inventory_20250831.csv", "a,b\n1,x\n")
    write(landing / "inventory_20250830.csv", "b,a,c\nx,1,2\n")  # another header
    write(landing / "salesorder_20250831.csv", "c\n3\n")
    write(landing / "other.csv", "d\n4\n")
    written = lifecycle.archive_batch(spark, str(landing), mapping, dest, AS_OF, purge=True)
    assert [w.removeprefix(dest) for w in written] == [
        "/20250831/inventory/inventory_20250830.csv",
        "/20250831/inventory/inventory_20250831.csv",
        "/20250831/other/other.csv",
        "/20250831/salesorder/salesorder_20250831.csv",
    ]
    assert rows(read_csv_text(spark, written[0])) == [("x", "1", "2")]
    assert not list(landing.glob("*.csv"))


# --- the whole day -----------------------------------------------------------------------


def fill(root, day, stock, sales, events):
    write(
        root / "landing" / f"inventory_{day:%Y%m%d}.csv",
        "warehouse_id,product_id,product_name,category,quantity_in_stock,last_restock_date\r\n"
        + "".join(f"{line}\r\n" for line in stock)
        + ",,,,,\r\n",
    )
    write(
        root / "landing" / f"salesorder_{day:%Y%m%d}.csv",
        "order_id,product_id,quantity_sold,sale_date,warehouse_id\r\n"
        + "".join(f"{line}\r\n" for line in sales)
        + ",,,,\r\n",
    )
    for i, e in enumerate(events):
        write(root / "bronze/streaming/landing_shipments" / f"{day:%Y%m%d}" / f"s_{i}.json", json.dumps(e, indent=2))


def event(shipment, warehouse, status, time, location="Delhi", **more):
    return dict(shipment_id=shipment, warehouse_id=warehouse, status=status, location=location, timestamp=time, **more)


def tables(spark, db):
    return {t.name: rows(spark.table(f"{db}.{t.name}")) for t in GOLD}


def test_two_days_end_to_end(spark, tmp_path):
    layout, db = Layout(f"{tmp_path}/lake"), "day_run"
    root = tmp_path / "lake"
    write(root / "bronze/batch/filemapping/fileMapping.json", json.dumps(MAPPING))
    first, second = AS_OF - timedelta(days=1), AS_OF
    fill(
        root,
        first,
        ["WH1,PRD1,Stand,Acc,263,7/2/2025", "WH2,PRD1,Stand,Acc,10,7/3/2025", "WH1,PRD2,Desk,Fur,40,2025-07-06"],
        ["ORD1,PRD1,2,8/29/2025,WH1", "ORD2,PRD1,3,2025-08-29,WH1", "ORD3,PRD2,1,1/1/2025,WH1"],
        [
            event("SH1", "WH1", "In Transit", "2025-08-30T01:00:00Z"),
            event("SH2", "WH2", "Delayed", "2025-08-30T02:00:00Z", "12.5,77.25", delay_reason="Weather"),
            event("SH3", "bad", "Delayed", "2025-08-30T02:00:00Z"),
        ],
    )
    try:
        run.run_streams(spark, layout, RUN_TS)
        run.run_batch(spark, layout, db, first, RUN_TS)
        after_first = tables(spark, db)
        assert after_first["dim_product"] == [("PRD1", "Stand", first, "inventory_silver"), ("PRD2", "Desk", first, "inventory_silver")]
        assert len(after_first["dim_warehouse"]) == 5
        # The January sale is older than the retention.
        assert [r[:2] + r[2:] for r in after_first["fact_sales_daily"]] == [("WH1", "PRD1", 5, date(2025, 8, 29))]
        assert [r[0] for r in after_first["fact_shipments"]] == ["SH1", "SH2"]
        assert [(r[0], r[1], r[5]) for r in after_first["supplychain_snapshot"]] == [
            ("WH1", "PRD1", "SH1"),
            ("WH1", "PRD2", "SH1"),
            ("WH2", "PRD1", "SH2"),
        ]
        assert [(r[0], r[3]) for r in after_first["alerts_shipments"]] == [("SH2", "Weather")]

        # The same day again: nothing changes.
        run.run_batch(spark, layout, db, first, RUN_TS)
        assert tables(spark, db) == after_first

        fill(
            root,
            second,
            ["WH1,PRD1,Stand Pro,Acc,7,8/30/2025"],
            ["ORD9,PRD1,9,8/30/2025,WH1"],
            [event("SH1", "WH1", "Delayed", "2025-08-31T01:00:00Z")],
        )
        run.run_streams(spark, layout, RUN_TS + timedelta(hours=1))
        report = run.run_batch(spark, layout, db, second, RUN_TS, purge=True)
        after_second = tables(spark, db)
        assert after_second["dim_product"][0] == ("PRD1", "Stand Pro", second, "inventory_silver")
        assert after_second["dim_product"][1] == after_first["dim_product"][1]
        for name, where in (("fact_inventory_daily", 5), ("supplychain_snapshot", 10)):
            old = [r for r in after_second[name] if r[where] == first]
            assert old == after_first[name]
        assert [(r[0], r[5], r[6]) for r in after_second["supplychain_snapshot"] if r[10] == second] == [("WH1", "SH1", "Delayed")]
        # A shipment has one row per day.
        assert [r[0] for r in after_second["fact_shipments"]] == ["SH1", "SH1", "SH2"]
        assert sorted((r[0], r[3]) for r in after_second["alerts_shipments"]) == [("SH1", "Traffic"), ("SH2", "Weather")]

        counts = {r.layer: r.row_count for r in report.collect()}
        assert counts["fact_shipments parquet"] == 3
        assert list((root / "landing").glob("*.csv")) == []
        # A purged day can be run again, from bronze.
        run.run_batch(spark, layout, db, second, RUN_TS)
        assert tables(spark, db) == after_second
        rejected = spark.read.parquet(f"{layout.quarantine}_shipments/{AS_OF:%Y%m%d}")
        assert rows(rejected.select("shipment_id", "reject_reason")) == [("SH3", "invalid shipment key")]

        first_load = run.run_serving(spark, layout, "day_serving")
        former = run.run_serving(spark, layout, "day_serving")
        assert len(former) == len(first_load) == len(GOLD)
        delete_paths(spark, former)
        assert tables(spark, "day_serving") == {
            t.name: rows(spark.table(f"{db}.{t.name}").select(t.schema.fieldNames())) for t in GOLD
        }
    finally:
        for name in (db, "day_serving"):
            spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


def test_serving_needs_the_acknowledgement(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        run.run_serving(spark, Layout(f"{tmp_path}/lake"), "never")


@pytest.mark.parametrize("dedup", ["first", "within_watermark"])
def test_run_streams_with_a_deduplicating_query(spark, tmp_path, dedup):
    layout = Layout(f"{tmp_path}/lake")
    fill(
        tmp_path / "lake",
        AS_OF,
        [],
        [],
        [event("SH1", "WH1", "In Transit", "2025-08-30T01:00:00Z"), event("SH1", "WH1", "In Transit", "2025-08-30T01:00:00Z")],
    )
    queries = run.run_streams(spark, layout, RUN_TS, dedup=dedup)
    assert [q.isActive for q in queries] == [False, False]
    assert spark.read.parquet(layout.silver_shipments).count() == 1


def test_run_streams_until_stopped(spark, tmp_path):
    layout = Layout(f"{tmp_path}/lake")
    queries = run.run_streams(spark, layout, RUN_TS, available_now=False)
    try:
        report = {r.name: r for r in stream_report(spark).collect()}
        assert set(report) == {"bronze_shipments", "silver_shipments"}
        assert all(r.is_active for r in report.values())
        fill(tmp_path / "lake", AS_OF, [], [], [event("SH1", "WH1", "Delayed", "2025-08-30T01:00:00Z")])
        for query in queries:
            query.processAllAvailable()
    finally:
        for query in queries:
            query.stop()
    state = run.silver_shipments_at_rest(spark, layout)
    assert rows(state.select("shipment_id", "status", "is_delayed")) == [("SH1", "Delayed", True)]
