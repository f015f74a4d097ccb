import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from signalloom.model import AUDIT_COLUMNS, struct_of
from signalloom.session import scratch_path, size_shuffles
from signalloom.sources.files import EXTRACTS, Lake, literal_rows, read_extract, read_extracts, read_json_landing, run_id
from signalloom.sources.rescue import rescued_json


def write_lines(spark, path, *lines):
    spark.createDataFrame([(line,) for line in lines], "value STRING").coalesce(1).write.mode("append").text(path)


def test_a_malformed_cell_becomes_null(spark):
    folder = scratch_path(spark, "csv")
    write_lines(
        spark, f"{folder}/order_items.csv", "order_id,sku,qty,unit_price", "o1,s1,2,9.5", "o2,s2,many,", "o3,s3,1,x"
    )
    extract = next(e for e in EXTRACTS if e.name == "order_items")
    df = read_extract(spark, folder, extract)
    assert rows(df, "order_id", "qty", "unit_price") == [("o1", 2, 9.5), ("o2", None, None), ("o3", 1, None)]
    row = df.first()
    assert "order_items.csv" in row._source_file and row._bronze_ingested_at is not None
    assert row._batch_run_id == run_id(spark) == "manual"


def test_every_extract_is_read_under_its_schema(spark):
    folder = scratch_path(spark, "csv")
    for e in EXTRACTS:
        write_lines(spark, f"{folder}/{e.name}.csv", ",".join(e.schema.fieldNames()))
    frames = read_extracts(spark, folder)
    assert list(frames) == ["customers", "products", "inventory", "orders", "order_items", "shipments"]
    for e in EXTRACTS:
        assert frames[e.name].columns[: len(e.schema)] == e.schema.fieldNames()
        assert set(e.keys) <= set(e.schema.fieldNames())


def test_json_landing_has_its_day(spark):
    folder = scratch_path(spark, "json")
    write_lines(spark, f"{folder}/dt=2024-01-05", '{"event_id":"a","quantity":2}')
    write_lines(spark, f"{folder}/dt=2024-01-06", '{"event_id":"b"}', "")
    df = read_json_landing(spark, folder)
    assert rows(df.where("event_id is not null"), "event_id", "quantity", "dt") == [
        ("a", 2, dt.date(2024, 1, 5)), ("b", None, dt.date(2024, 1, 6)),
    ]
    assert df.where("dt = '2024-01-06' and event_id is not null").count() == 1


SCHEMA = struct_of("id STRING, n INT, price DOUBLE")


@pytest.mark.parametrize(
    "line, fields, rescued",
    [
        ('{"id":"a","n":1,"price":2.5}', ("a", 1, 2.5), None),
        ('{"id":"a"}', ("a", None, None), None),
        ('{"id":"a","n":null}', ("a", None, None), None),
        ('{"id":"a","n":"many"}', ("a", None, None), {"n": "many"}),
        ('{"id":7,"n":1,"price":1}', ("7", 1, 1.0), None),
        ('{"id":"a","n":1,"extra":"x","more":{"y":1}}', ("a", 1, None), {"extra": "x", "more": '{"y":1}'}),
        ("no json", (None, None, None), {"_line": "no json"}),
        ('{"id":"a","n":1', (None, None, None), {"_line": '{"id":"a","n":1'}),
        (None, (None, None, None), None),
    ],
)
def test_rescue(spark, line, fields, rescued):
    df = rescued_json(spark.createDataFrame([(line, "f")], "value STRING, file STRING"), SCHEMA)
    row = df.first()
    assert (row.id, row.n, row.price) == fields and row.file == "f"
    assert row._rescued_data == rescued


def test_names_and_paths():
    lake = Lake("/data/", env="staging")
    assert lake.table("silver", "orders") == "retail_staging.silver.orders"
    assert lake.path("silver", "orders") == "/data/retail_staging/silver/orders"
    assert lake.checkpoint("landing") == "/data/checkpoints/staging/landing"
    with pytest.raises(ValueError):
        lake.path("copper", "orders")


def test_shuffle_partitions_grow_with_the_input_only(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        assert size_shuffles(spark, 10_000) == int(before)
        assert size_shuffles(spark, 100 * 256 * 1024**2) == 100
        assert size_shuffles(spark, 0) == 100
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_a_row_of_nulls_has_the_declared_types(spark):
    df = literal_rows(spark, [{"job_name": "j"}], struct_of(AUDIT_COLUMNS))
    assert df.schema == struct_of(AUDIT_COLUMNS)
    assert df.where(F.col("row_count").isNull()).count() == 1
