from __future__ import annotations

from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataload.functions import LoadRange
from strataload.operators.upsert import sync_all_columns, upsert_by_key
from strataload.schemas import DIM_TRANSACTION, FACT_POLICYTRANSACTION, SEED_TRANSACTIONS, unknown_member
from strataload.sources.scratch import fresh_path, settle, shared_root
from strataload.sources.seeds import read_seed, transaction_types
from strataload.sources.staged_csv import export_range, load_staged, read_staged
from strataload.sources.store import Store

AT = datetime(2024, 1, 1)


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, str(tmp_path))


def test_a_table_can_be_rebuilt_from_itself(spark, store):
    assert store.read("dim_limit").count() == 0
    store.write("dim_limit", unknown_member(spark, "dim_limit", AT))
    more = store.read("dim_limit").withColumn("limit_id", F.col("limit_id") + 1)
    store.write("dim_limit", store.read("dim_limit").unionByName(more))
    assert sorted(r.limit_id for r in store.read("dim_limit").collect()) == [0, 1]
    assert store.versions("dim_limit") == [1, 2]
    store.drop_old_versions("dim_limit", keep=1)
    assert store.versions("dim_limit") == [2]


def test_a_dead_attempt_is_not_read(spark, store, tmp_path):
    store.write("dim_limit", unknown_member(spark, "dim_limit", AT))
    dead = tmp_path / "dim_limit" / "version=00000002"
    spark.range(3).write.parquet(str(dead))
    (dead / "_SUCCESS").unlink()
    assert store.versions("dim_limit") == [1]
    assert store.read("dim_limit").count() == 1
    store.write("dim_limit", unknown_member(spark, "dim_limit", AT))
    assert store.versions("dim_limit") == [1, 2] and store.read("dim_limit").count() == 1


def test_schema_sync_on_write(spark, store):
    extra = unknown_member(spark, "dim_limit", AT).drop("limit2").withColumn("old", F.lit(1))
    row = store.write("dim_limit", extra).first()
    assert row.asDict() == {"limit_id": 0, "limit1": "~", "limit2": None, "loaddate": AT}
    layout = T.StructType([T.StructField("a", T.LongType()), T.StructField("n", T.StringType())])
    assert sync_all_columns(spark.createDataFrame([(1, 2)], "a int, b int"), layout).collect() == [(1, None)]


def fact_rows(spark, *rows):
    values = [
        tuple({"transactiondate": d, "policy_id": p, "amount": Decimal(a), "loaddate": AT}.get(n) for n in FACT_POLICYTRANSACTION.names)
        for d, p, a in rows
    ]
    return spark.createDataFrame(values, FACT_POLICYTRANSACTION)


@pytest.mark.parametrize("grain", ["day", "month"])
def test_L24_reloading_a_range_replaces_it(spark, tmp_path, grain):
    store = Store(spark, str(tmp_path), grain)
    name = "fact_policytransaction"
    assert store.read_partitioned(name).count() == 0
    store.replace_range(name, fact_rows(spark, (20200110, 1, 1), (20200115, 1, 2), (20200115, 1, 2)), LoadRange(20200101, 20200115))
    second = LoadRange(20200115, 20200210)
    for amount in (3, 4, 4):
        store.replace_range(name, fact_rows(spark, (20200116, 2, amount), (20200205, 2, amount)), second)
    rows = sorted((r.transactiondate, r.policy_id, int(r.amount)) for r in store.read_partitioned(name).collect())
    assert rows == [(20200110, 1, 1), (20200115, 1, 2), (20200115, 1, 2), (20200116, 2, 4), (20200205, 2, 4)]
    assert store.read_partitioned(name).schema.names == FACT_POLICYTRANSACTION.names
    dates = lambda: sorted({r.transactiondate for r in store.read_partitioned(name).collect()})
    store.replace_range(name, fact_rows(spark, (20200116, 2, 5)), second)  # shrinks
    assert dates() == [20200110, 20200115, 20200116]
    store.replace_range(name, fact_rows(spark).limit(0), second)
    assert dates() == [20200110, 20200115]
    store.clear(name)
    assert store.read_partitioned(name).count() == 0


def test_upsert_updates_and_inserts(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    batch = spark.createDataFrame([("B", 2), ("C", 3)], "v string, k int")
    assert sorted(map(tuple, upsert_by_key(target, batch, ["k"]).collect())) == [(1, "a"), (2, "B"), (3, "C")]


CSV = T.StructType([
    T.StructField("transactiondate", T.IntegerType()), T.StructField("text", T.StringType()),
    T.StructField("amount", T.DecimalType(18, 2)), T.StructField("at", T.TimestampNTZType()),
])


def test_csv_keeps_spaces_marks_breaks_and_microseconds(spark, tmp_path):
    path = str(tmp_path / "csv")
    texts = [" lead", "trail ", "\\N", "\\\\N", "a\nb", "a\r\nb", 'q"q', "", None, ",", "\\"]
    rows = [(20200101, t, datetime(2020, 1, 1, 1, 2, 3, 123456)) for t in texts]
    df = spark.createDataFrame(rows, "transactiondate int, t string, at timestamp_ntz")
    export_range(df, LoadRange(20191231, 20200102), path)
    got = read_staged(spark, path, df.schema).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, rows))


def test_csv_round_trip_keeps_quotes_nulls_and_blanks(spark, tmp_path):
    rows = [
        (20200102, 'a "quoted", text', Decimal("1.50"), datetime(2020, 1, 2, 3, 4, 5)),
        (20200103, None, None, None), (20200104, "", Decimal("-2.00"), None), (20200105, "outside", None, None),
        (20200102, "back\\slash", Decimal("0.00"), None),
    ]
    source = spark.createDataFrame(rows, CSV)
    path, table = str(tmp_path / "csv"), str(tmp_path / "stg")
    load = LoadRange(20200101, 20200104)
    export_range(source, load, path)
    export_range(source, load, path)
    got = sorted(map(tuple, read_staged(spark, path, CSV).collect()), key=repr)
    assert got == sorted([rows[0], rows[1], rows[2], rows[4]], key=repr)
    for _ in range(2):
        load_staged(spark, path, CSV, table)
    assert spark.read.parquet(table).count() == 8


def test_bad_staged_value_raises(spark, tmp_path):
    spark.createDataFrame([("x,a,1.0,",)], "v string").write.text(str(tmp_path / "bad"))
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        read_staged(spark, str(tmp_path / "bad"), CSV).collect()


def test_seed_from_file_and_from_code(spark, tmp_path):
    path = tmp_path / "seed.csv"
    path.write_text("transaction_id,transactioncd\n" + "\n".join(f"{i},{t}" for i, t in SEED_TRANSACTIONS))
    assert read_seed(spark, str(path), DIM_TRANSACTION).collect() == transaction_types(spark).collect()


def test_scratch_is_below_the_shared_folder(spark):
    assert fresh_path(spark, "x").startswith(shared_root(spark))
    df = settle(spark.range(5))
    assert df.count() == 5 and "ParquetScan" not in str(df.schema)
    assert shared_root(spark) == (spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir"))
