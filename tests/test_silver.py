from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from depotlake.plans import silver
from depotlake.schemas import INVENTORY_CSV, INVENTORY_OPTIONAL, SALES_CSV
from depotlake.sources import read_csv_by_name, read_csv_text
from tests.conftest import RUN_TS
from tests.helpers import rows

INVENTORY = "warehouse_id string, product_id string, product_name string, quantity_in_stock string, last_restock_date string"
SALES = "order_id string, product_id string, quantity_sold string, sale_date string, warehouse_id string"


def test_silver_inventory(spark):
    raw = spark.createDataFrame(
        [
            (" wh1", "prd1", " Lamp ", "10", "7/2/2025"),
            ("WH1", "PRD1", "Lamp", "20", "2025-07-05"),  # same key, later
            ("wh1", "prd2", "Desk", None, "7/2/2025"),
            ("wh1", "prd3", "Chair", "5", "13/45/2025"),  # unreadable date
            ("wh1", "prd3", "Chair", "6", "7/1/2025"),  # a dated row beats it
            ("wh1", "prd4", "Hub", "many", None),
            ("wh2", "prd5", "Mat", "7", "7/2/2025"),
            ("wh2", "prd5", "Mat", "8", "7/2/2025"),  # tie
            ("wh1", None, "Lamp", "1", "7/2/2025"),
            ("wh1", "prd6", None, "1", "7/2/2025"),
            (None, "prd7", "Clock", "3", "7/2/2025"),  # no rule on the warehouse
            (None, None, None, None, None),
        ],
        INVENTORY,
    )
    result = silver.silver_inventory(raw, RUN_TS)
    assert result.columns[-2:] == ["ingestion_timestamp", "source_system"]
    assert {tuple(r) for r in result.select("ingestion_timestamp", "source_system").collect()} == {
        (RUN_TS, "aws-s3")
    }
    assert rows(result.drop("ingestion_timestamp", "source_system")) == [
        (None, "PRD7", "Clock", 3, date(2025, 7, 2)),
        ("WH1", "PRD1", "Lamp", 20, date(2025, 7, 5)),
        ("WH1", "PRD2", "Desk", 0, date(2025, 7, 2)),
        ("WH1", "PRD3", "Chair", 6, date(2025, 7, 1)),
        ("WH1", "PRD4", "Hub", None, None),
        ("WH2", "PRD5", "Mat", 8, date(2025, 7, 2)),
    ]


def test_silver_sales(spark):
    raw = spark.createDataFrame(
        [
            ("o1", "p1", "3", "2025-07-01", "wh1"),
            ("O1", " p1", "4", "7/2/2025", "WH1"),
            ("o1", "p1", "5", None, "wh1"),
            ("o2", "p1", None, "nonsense", "wh1"),
            (None, "p1", "1", "2025-07-01", "wh1"),
            ("o3", None, "1", "2025-07-01", "wh1"),
            ("o4", "p1", "1", "2025-07-01", None),
        ],
        SALES,
    )
    result = silver.silver_sales(raw, RUN_TS).drop("ingestion_timestamp", "source_system")
    assert rows(result) == [
        ("O1", "P1", 4, date(2025, 7, 2), "WH1"),
        ("O2", "P1", 0, None, "WH1"),
    ]


def test_quarantine_names_every_loss(spark):
    inventory = spark.createDataFrame(
        [
            ("wh1", "p1", "Lamp", "1", "13/45/2025"),
            ("wh1", None, "Lamp", "1", "7/2/2025"),
            ("wh1", "p2", None, "1", "7/2/2025"),
            (None, None, None, None, None),
            ("wh1", "p3", "Desk", "1", "7/2/2025"),
            ("wh1", "  ", "Desk", "1", "7/2/2025"),
            ("wh1", "p4", "Desk", "1,200", "7/2/2025"),
            ("wh1", "p5", "Desk", None, "7/2/2025"),
        ],
        INVENTORY,
    )
    sales = spark.createDataFrame(
        [
            (None, "p1", "1", "2025-07-01", "wh1"),
            ("o4", "", "1", "2025-07-01", "wh1"),
            ("o5", "p1", "12.0", "2025-07-01", "wh1"),
            ("o1", "p1", "1", "soon", "wh1"),
            ("o2", "p1", "1", None, "wh1"),
            ("o3", "p1", "1", "2025-07-01", None),
        ],
        SALES,
    )
    found = silver.quarantine(inventory, sales).select("entity", "reject_reason", "dropped")
    assert rows(found) == [
        ("inventory", "blank line", True),
        ("inventory", "missing product_id", True),
        ("inventory", "missing product_id", True),
        ("inventory", "missing product_name", True),
        ("inventory", "unparsed date", False),
        ("inventory", "unreadable quantity", False),
        ("sales", "missing order_id", True),
        ("sales", "missing product_id", True),
        ("sales", "missing warehouse_id", True),
        ("sales", "unparsed date", False),
        ("sales", "unreadable quantity", False),
    ]
    stored = silver.silver_inventory(inventory).select("product_id", "quantity_in_stock")
    assert rows(stored) == [("P1", 1), ("P3", 1), ("P4", None), ("P5", 0)]


@pytest.fixture
def bronze(spark):
    def build(*events):
        df = spark.createDataFrame(
            list(events),
            "shipment_id string, warehouse_id string, status string, location string, timestamp string,"
            " delay_reason string, ingested timestamp",
        )
        return silver.standardise_shipments(df, F.col("ingested")).drop("ingested")

    return build


def at(hour):
    return datetime(2025, 8, 31, hour)


def test_shipment_events_in_are_out_or_rejected_or_repeated(bronze):
    events = bronze(
        ("s1", "wh1", "in transit", "x", "2025-08-31T13:00:00Z", None, at(1)),
        ("s1", "wh1", "delayed", "x", "2025-08-31T14:00:00Z", None, at(2)),
        ("s2", "X9", "delayed", "x", "2025-08-31T14:00:00Z", None, at(2)),
        (None, "wh1", "delayed", "x", "2025-08-31T14:00:00Z", None, at(2)),
        ("s3", None, "delayed", "x", "soon", None, at(2)),
        ("s4", "wh1", "delayed", "x", "soon", None, at(2)),
    )
    found = silver.quarantine_shipments(events).select("shipment_id", "reject_reason")
    assert sorted(map(str, rows(found))) == sorted(
        map(
            str,
            [
                (None, "invalid shipment key"),
                ("S2", "invalid shipment key"),
                ("S3", "invalid shipment key"),
                ("S4", "no readable event time"),
            ],
        )
    )
    kept = silver.silver_shipments(events, at(3)).filter("timestamp IS NOT NULL")
    repeated = 1
    assert events.count() == kept.count() + found.count() + repeated


def test_standardise_shipments(bronze):
    df = bronze((" sh1 ", " wh2", " In TRANSIT ", " x ", "2025-08-31T13:26:34Z", " Rain ", at(1)))
    assert rows(df) == [
        ("SH1", "WH2", "in transit", " x ", datetime(2025, 8, 31, 13, 26, 34), "Rain", at(1), "TMS_live")
    ]


def test_silver_shipments_choose_the_latest_valid_event(bronze):
    df = bronze(
        ("sh1", "wh1", "In Transit", "mumbai", "2025-08-31T01:00:00Z", None, at(1)),
        ("sh1", "wh1", "DELAYED", "12.9,77.5", "2025-08-31T02:00:00Z", "Rain", at(2)),
        ("sh1", "whx", "delivered", "delhi", "2025-08-31T03:00:00Z", None, at(3)),
        ("sh2", "wh2", "lost", None, "not a time", None, at(1)),
        (None, "wh2", "delayed", None, "2025-08-31T01:00:00Z", None, at(1)),
        ("sh3", "oops", "delayed", None, "2025-08-31T01:00:00Z", None, at(1)),
    )
    columns = ["shipment_id", "warehouse_id", "status", "is_delayed", "is_recent", "latitude", "city"]
    latest = silver.silver_shipments(df, RUN_TS).select(columns)
    assert rows(latest) == [
        ("SH1", "WH1", "Delayed", True, True, 12.9, None),
        ("SH2", "WH2", "Unknown", False, None, None, None),
    ]
    # The old order: the invalid newest event hides the shipment.
    parity = silver.silver_shipments(df, RUN_TS, parity=True).select(columns)
    assert rows(parity) == [("SH2", "WH2", "Unknown", False, None, None, None)]


# --- files bound by header ---------------------------------------------------------------


def test_csv_is_bound_by_header_name(spark, tmp_path):
    path = tmp_path / "inventory.csv"
    path.write_bytes(
        b"warehouse_id,product_id,product_name,category,quantity_in_stock,last_restock_date\r\n"
        b"WH1,PRD1,Stand,Accessories,263,7/2/2025\r\n"
        b'WH2,PRD2,"Desk, tall",Furniture,57,7/6/2025\r\n'
        b",,,,,\r\n"
    )
    df = read_csv_by_name(spark, str(path), INVENTORY_CSV, INVENTORY_OPTIONAL)
    result = silver.silver_inventory(df, RUN_TS).drop("ingestion_timestamp", "source_system")
    assert rows(result) == [
        ("WH1", "PRD1", "Stand", 263, date(2025, 7, 2)),
        ("WH2", "PRD2", "Desk, tall", 57, date(2025, 7, 6)),
    ]
    _, rejected = silver.split_inventory(df)
    assert rows(rejected.select("reject_reason")) == [("blank line",)]


def test_csv_optional_and_missing_columns(spark, tmp_path):
    without = tmp_path / "a.csv"
    without.write_text("product_id,warehouse_id,extra,product_name,last_restock_date,quantity_in_stock\nP,W,e,N,d,4\n")
    df = read_csv_by_name(spark, str(without), INVENTORY_CSV, INVENTORY_OPTIONAL)
    assert rows(df) == [("W", "P", "N", None, "4", "d")]
    with pytest.raises(ValueError, match="order_id"):
        read_csv_by_name(spark, str(without), SALES_CSV)


def test_csv_text_keeps_everything_as_text(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text('a,b\n007,"say \\"hi\\""\n')
    assert rows(read_csv_text(spark, str(path))) == [("007", 'say "hi"')]
