"""Daily sales by signed differences against a recompute of all lines; incremental publication; balanced writes."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from depotlake.operators import is_rejected, write_balanced
from depotlake.operators.latest import latest_by, latest_counted
from depotlake.plans import increments, silver
from depotlake.schemas import DIM_PRODUCT, FACT_SALES_DAILY, FACT_SHIPMENTS, GOLD
from depotlake.sinks import ensure_tables, load_serving, publish, publish_changed, read_export, replace_partitions, replace_table
from depotlake.sources import path_exists
from tests.helpers import rows
from tests.test_sinks import SHIPMENT, filled

D = date(2025, 8, 1)


def lines(spark, *found):
    return spark.createDataFrame(list(found), "order_id string, product_id string, warehouse_id string, sale_date date, quantity_sold int")


def recomputed(spark, *batches):
    every = [r for b in batches for r in b]
    newest = latest_by(lines(spark, *every), silver.SALES_KEYS, ["sale_date"])
    daily = newest.where("sale_date IS NOT NULL").groupBy("warehouse_id", "product_id", "sale_date")
    return rows(daily.agg(F.sum(F.coalesce("quantity_sold", F.lit(0))).cast("long").alias("qty_sold")))


def test_corrections_give_what_a_recompute_gives(spark, db, tmp_path):
    ensure_tables(spark, db, [FACT_SALES_DAILY])
    chance, batches = random.Random(3), []
    for step in range(4):
        batch = []
        for _ in range(40 if not step else 8):
            day = None if chance.random() < 0.1 else D + timedelta(days=chance.randrange(6) + step)
            batch.append((f"O{chance.randrange(25)}", f"P{chance.randrange(2)}", "WH1", day, chance.choice([None, 1, 5, 9])))
        batches.append(batch)
        increments.merge_sales(spark, lines(spark, *batch), db, f"{tmp_path}/state")
        expected = recomputed(spark, *batches)
        assert rows(spark.table(f"{db}.fact_sales_daily").select("warehouse_id", "product_id", "sale_date", "qty_sold")) == expected
        # The same lines again make no difference.
        assert increments.merge_sales(spark, lines(spark, *batch), db, f"{tmp_path}/state") == []


def test_a_day_that_loses_its_last_line_goes_and_stays_away(spark, db, tmp_path):
    ensure_tables(spark, db, [FACT_SALES_DAILY])
    merge = lambda *found: increments.merge_sales(spark, lines(spark, *found), db, f"{tmp_path}/state")
    assert merge(("O1", "P1", "WH1", D, 5), ("O2", "P1", "WH1", D + timedelta(days=1), 1)) == [D, D + timedelta(days=1)]
    later = D + timedelta(days=increments.DAY_BUCKETS)
    assert merge(("O1", "P1", "WH1", later, 5)) == [D, later]
    assert merge(("O2", "P1", "WH1", D + timedelta(days=1), 4)) == [D + timedelta(days=1)]
    table = spark.table(f"{db}.fact_sales_daily").select("sale_date", "qty_sold")
    assert rows(table) == [(D + timedelta(days=1), 4), (later, 5)]
    assert str(D) not in {r[0].split("=")[1] for r in spark.sql(f"SHOW PARTITIONS {db}.fact_sales_daily").collect()}


def test_a_run_that_died_before_its_lines_is_made_again(spark, db, tmp_path, monkeypatch):
    ensure_tables(spark, db, [FACT_SALES_DAILY])
    state = f"{tmp_path}/state"
    increments.merge_sales(spark, lines(spark, ("O1", "P1", "WH1", D, 5)), db, state)
    real = increments.write_version

    def dying(frame, path, version):
        if path.endswith("lines"):
            raise OSError("lost")
        real(frame, path, version)

    monkeypatch.setattr(increments, "write_version", dying)
    with pytest.raises(OSError, match="lost"):
        increments.merge_sales(spark, lines(spark, ("O1", "P1", "WH1", D, 9), ("O2", "P1", "WH1", D, 1)), db, state)
    monkeypatch.setattr(increments, "write_version", real)
    increments.merge_sales(spark, lines(spark, ("O1", "P1", "WH1", D, 9), ("O2", "P1", "WH1", D, 1)), db, state)
    assert rows(spark.table(f"{db}.fact_sales_daily").select("qty_sold")) == [(10,)]


def test_a_run_that_died_after_its_lines_is_made_again(spark, db, tmp_path, monkeypatch):
    ensure_tables(spark, db, [FACT_SALES_DAILY])
    state = f"{tmp_path}/state"
    merge = lambda *found: increments.merge_sales(spark, lines(spark, *found), db, state)
    first, second = [("O1", "P1", "WH1", D, 5), ("O3", "P1", "WH1", None, None)], [("O1", "P1", "WH1", D + timedelta(days=1), 9), ("O2", "P1", "WH1", D, 1)]
    merge(*first)

    def dying(*_):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(increments, "_replace_days", dying)
        with pytest.raises(OSError, match="lost"):
            merge(*second)
    # Its lines are there, but do not count.
    assert merge(*second) == [D, D + timedelta(days=1)] and merge(*second) == []
    expected = recomputed(spark, first, second)
    assert rows(spark.table(f"{db}.fact_sales_daily").select("warehouse_id", "product_id", "sale_date", "qty_sold")) == expected


def test_lines_are_dealt_and_grouped_once(spark, db, tmp_path, monkeypatch):
    """Each run reads the known lines once and deals them out once, for their differences and their new version alike."""
    ensure_tables(spark, db, [FACT_SALES_DAILY])
    read, real = [], increments.read_versions

    def reading(session, path, *rest, **named):
        read.append(path.rsplit("/", 1)[1])
        return real(session, path, *rest, **named)

    monkeypatch.setattr(increments, "read_versions", reading)
    plans, write = [], increments.write_version

    def writing(frame, path, version):
        plans.append((path.rsplit("/", 1)[1], frame._jdf.queryExecution().executedPlan().toString()))
        write(frame, path, version)

    monkeypatch.setattr(increments, "write_version", writing)
    increments.merge_sales(spark, lines(spark, ("O1", "P1", "WH1", D, 5), (None, "P1", "WH1", D, 2), (None, "P1", "WH1", D, 3)), db, f"{tmp_path}/state")
    plan = next(p for kind, p in plans if kind == "lines")
    assert read.count("lines") == 1 and plan.count("Exchange") == 1 and plan.count("Sort ") == 1
    assert rows(spark.table(f"{db}.fact_sales_daily").select("qty_sold")) == [(8,)]


def test_alerts_of_touched_days_only(spark, db, tmp_path):
    from depotlake.plans import run
    from depotlake.schemas import ALERTS_SHIPMENTS

    ensure_tables(spark, db, [FACT_SHIPMENTS, ALERTS_SHIPMENTS])
    names = FACT_SHIPMENTS.schema.fieldNames()

    def fact(shipment, day, delayed=True):
        values = dict(zip(names, SHIPMENT, strict=True))
        values |= {"shipment_id": shipment, "event_date": day, "is_delayed": delayed, "status": "Delayed" if delayed else "Delivered"}
        return tuple(values[n] for n in names)

    write = lambda *facts: replace_partitions(spark.createDataFrame(list(facts), FACT_SHIPMENTS.schema), db, FACT_SHIPMENTS)
    update = lambda: run.update_alerts(spark, db, f"{tmp_path}/seen")
    days = [D, D + timedelta(days=1)]
    write(fact("S1", days[0]), fact("S2", days[1]), fact("S3", days[1], delayed=False))
    assert update() == [str(d) for d in days] and update() == []
    alerts = spark.table(f"{db}.{ALERTS_SHIPMENTS.name}")
    assert rows(alerts.select("shipment_id")) == [("S1",), ("S2",)]
    write(fact("S2", days[1]), fact("S4", days[1]))
    assert update() == [str(days[1])]
    assert rows(spark.table(f"{db}.{ALERTS_SHIPMENTS.name}").select("shipment_id")) == [("S1",), ("S2",), ("S4",)]


# --- publication -------------------------------------------------------------------------


def files_of(path):
    return {str(p): p.stat().st_mtime_ns for p in path.rglob("part-*") if "_digests" not in str(p) and "_success" not in str(p)}


def test_an_unchanged_day_writes_nothing(spark, db, tmp_path):
    filled(spark, db)
    out = tmp_path / "gold"
    publish(spark, db, str(out))  # copies of whole tables, as an earlier full publication left them
    first = {r.layer: (r.row_count, r.parts_written) for r in publish_changed(spark, db, str(out)).collect()}
    assert first["fact_shipments"] == first["fact_shipments csv"] == (1, 1) and first["alerts_shipments"] == (0, 0)
    assert rows(read_export(spark, f"{out}/fact_shipments_parquet", "parquet", FACT_SHIPMENTS)) == [SHIPMENT]
    assert rows(read_export(spark, f"{out}/tables/fact_shipments", "csv", FACT_SHIPMENTS)) == [SHIPMENT]
    before = files_of(out)
    second = publish_changed(spark, db, str(out)).collect()
    assert all(r.parts_written == 0 for r in second) and files_of(out) == before
    # One table changes: its files alone are new.
    replace_table(spark.createDataFrame([("P1", "b", D, "s"), ("P2", None, D, "s")], DIM_PRODUCT.schema), db, DIM_PRODUCT)
    third = {r.layer: (r.row_count, r.parts_written) for r in publish_changed(spark, db, str(out)).collect()}
    assert third["dim_product parquet"] == (2, 1) and third["fact_shipments"] == (1, 0)
    assert {p for p in files_of(out).items() if "dim_product" not in p[0]} == {p for p in before.items() if "dim_product" not in p[0]}
    assert rows(read_export(spark, f"{out}/tables/dim_product", "csv", DIM_PRODUCT)) == [("P1", "b", D, "s"), ("P2", None, D, "s")]
    spark.sql(f"CREATE DATABASE {db}_serving LOCATION '{tmp_path}/serving'")
    try:
        for table in GOLD:
            load_serving(spark, str(out), f"{db}_serving", table)
        assert rows(spark.table(f"{db}_serving.fact_shipments")) == [SHIPMENT]
    finally:
        spark.sql(f"DROP DATABASE {db}_serving CASCADE")


def test_days_without_a_date_and_days_that_are_gone(spark, db, tmp_path):
    ensure_tables(spark, db, [FACT_SHIPMENTS])
    day = FACT_SHIPMENTS.schema.fieldNames().index("event_date")
    other = tuple(date(2025, 1, 2) if i == day else v for i, v in enumerate(SHIPMENT))
    replace_partitions(spark.createDataFrame([SHIPMENT, other], FACT_SHIPMENTS.schema), db, FACT_SHIPMENTS)
    out = f"{tmp_path}/gold"
    publish_changed(spark, db, out, [FACT_SHIPMENTS])
    spark.sql(f"ALTER TABLE {db}.fact_shipments DROP PARTITION (event_date = DATE '2025-01-02')")
    publish_changed(spark, db, out, [FACT_SHIPMENTS])
    for fmt, path in (("csv", f"{out}/tables/fact_shipments"), ("parquet", f"{out}/fact_shipments_parquet")):
        assert rows(read_export(spark, path, fmt, FACT_SHIPMENTS)) == [SHIPMENT]


def test_a_lost_export_is_made_again(spark, db, tmp_path, monkeypatch):
    import depotlake.sinks.publishing as module

    filled(spark, db)
    real = module._export_parts
    monkeypatch.setattr(module, "_export_parts", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError, match="lost"):
        publish_changed(spark, db, f"{tmp_path}/gold")
    assert not path_exists(spark, f"{tmp_path}/gold/_success")
    monkeypatch.setattr(module, "_export_parts", real)
    report = {r.layer: r.parts_written for r in publish_changed(spark, db, f"{tmp_path}/gold").collect()}
    assert report["fact_shipments"] == 1 and path_exists(spark, f"{tmp_path}/gold/_success")


# --- balance -----------------------------------------------------------------------------


def test_a_write_is_balanced_with_one_scan_of_the_raw_rows(spark, tmp_path):
    raw = spark.createDataFrame([("a", 1), ("a", 2), ("a", 2), ("b", 1), (None, 1), (" ", 2)], "k string, v int")
    read = spark.sparkContext.accumulator(0)

    def passing(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    scanned = raw.mapInArrow(passing, raw.schema)
    bad = is_rejected({"missing": F.col("k").isNull() | (F.trim("k") == "")})
    out = f"{tmp_path}/out"
    report = write_balanced(
        "e",
        scanned,
        bad,
        lambda seen: latest_counted(seen.filter(~bad), ["k"], ["v"]),
        lambda frame: frame.write.parquet(out),
        lambda: spark.read.parquet(out),
    )
    assert rows(report) == [("e", 6, 2, 2, 2, True)] and read.value == 6
    assert rows(spark.read.parquet(out)) == [("a", 2), ("b", 1)]
    lossy = write_balanced(
        "e", raw, bad, lambda seen: latest_counted(seen.filter(~bad), ["k"], ["v"]), lambda frame: frame.where("k = 'a'").write.parquet(f"{out}2"), lambda: spark.read.parquet(f"{out}2")
    )
    assert not lossy.first().is_balanced


def test_counted_rows_are_those_of_the_rank(spark):
    chance = random.Random(1)
    data = [(f"k{chance.randrange(9)}", chance.choice([None, 1, 2]), chance.choice([None, "x", "y"])) for _ in range(200)]
    df = spark.createDataFrame(data, "k string, at int, other string")
    assert rows(latest_counted(df, ["k"], ["at"]).drop("_repeats")) == rows(latest_by(df, ["k"], ["at"]))
    assert latest_counted(df, ["k"], ["at"]).agg(F.sum("_repeats")).first()[0] == 200 - 9
