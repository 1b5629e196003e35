from __future__ import annotations

import hashlib
from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import functions as F

from strataload.functions import LoadRange, entity_id, iso_date, month_of, surrogate_key, version_key
from strataload.operators import dims
from strataload.operators.staging import stage_driver, stage_vehicle
from strataload.schemas import DIM_COVERAGE, DIM_DEDUCTIBLE, DIM_LIMIT, STG_PT, empty, typed, unknown_member

AT = datetime(2024, 1, 1)
LOAD = LoadRange(20200101, 20200131)


def stg(spark, *rows):
    """Staging rows from partial dicts; transactiondate is inside the range by default."""
    names = STG_PT.names
    return spark.createDataFrame(
        [tuple({"transactiondate": 20200110, **r}.get(n) for n in names) for r in rows], STG_PT
    )


def test_L1_L2_ranges(spark):
    df = stg(spark, *[{"transactiondate": d} for d in (20200101, 20200102, 20200131, 20200201)])
    dates = lambda load: sorted(r[0] for r in load.rows(df).select("transactiondate").collect())
    assert dates(LOAD) == [20200102, 20200131]
    assert dates(LoadRange(high=20200131, initial=True)) == [20200131]
    assert dates(LoadRange(initial=True)) == []


def test_key_functions(spark):
    df = spark.createDataFrame([(1, "a", datetime(2020, 4, 5, 6, 7, 8)), (2, None, None)], "n int, s string, t timestamp_ntz")
    rows = df.select(
        entity_id("n", "s").alias("e"), version_key(entity_id("n", "s"), F.col("t")).alias("v"),
        surrogate_key("n", "s").alias("k"), iso_date(F.col("t")).alias("d"),
    ).collect()
    md5 = lambda text: hashlib.md5(text.encode()).hexdigest()
    assert rows[0].e == "1_a" and rows[1].e is None  # L16
    assert rows[0].v == md5("1_a|2020-04-05 06:07:08.000000") and rows[1].v == md5("|")
    assert rows[0].k == md5("1-a") and rows[1].k == md5("2-_dbt_utils_surrogate_key_null_")
    assert rows[0].d == "2020-04-05"  # L14


def test_month(spark):
    assert spark.range(1).select(month_of(F.lit(20200215))).first()[0] == 202002


def test_L12_L13_typed_cuts_text_and_keeps_cents(spark):
    row = typed(stg(spark, {"policystate": "CAX", "amount": Decimal("1.25")}), STG_PT).first()
    assert row.policystate == "CA" and row.amount == Decimal("1.25")


def test_stage_takes_the_largest_of_conflicting_attributes(spark):
    common = {"policy_uniqueid": 7, "riskcd1": "1", "riskcd2": "2",
              "veh_effectivedate": datetime(2020, 1, 1), "drv_effectivedate": datetime(2020, 1, 1)}
    df = stg(
        spark,
        {**common, "vin": "A", "model": "z", "birthdate": date(1990, 5, 6), "pointschargedterm": 3},
        {**common, "vin": "B", "model": "y"},
        {**common, "vin": "Z", "transactiondate": 20200201},
    )
    vehicle = stage_vehicle(df, LOAD).collect()
    assert [(v.vehicle_uniqueid, v.vin, v.model, v.modelyr) for v in vehicle] == [("7_1", "B", "z", None)]
    driver = stage_driver(df, LOAD).first()
    assert (driver.driver_uniqueid, driver.birthdate, driver.pointscharged) == ("7_2", "1990-05-06", "3")


def test_L22_policy_takes_the_highest_sequence_of_its_batch_once(spark):
    df = stg(
        spark,
        {"policy_uniqueid": 1, "transactionsequence": 1, "policystate": "AA"},
        {"policy_uniqueid": 1, "transactionsequence": 2, "policystate": "CA"},
        {"policy_uniqueid": 1, "transactionsequence": 2, "policystate": "BA"},
        {"policy_uniqueid": 1, "transactionsequence": 9, "policystate": "ZZ", "transactiondate": 20200301},
        {"policy_uniqueid": None, "transactionsequence": 2},
    )
    rows = dims.dim_policy(df, LOAD, AT).collect()
    assert [(r.policy_id, r.policystate, r.policynumber, r.effectivedate) for r in rows] == [
        (1, "BA", "~", date(1900, 1, 1))
    ]


def test_L23_a_later_batch_wins_even_with_a_lower_sequence(spark):
    from strataload.operators.upsert import upsert_by_key

    first = dims.dim_policy(stg(spark, {"policy_uniqueid": 1, "transactionsequence": 5, "policystate": "AA"}), LOAD, AT)
    later = dims.dim_policy(stg(spark, {"policy_uniqueid": 1, "transactionsequence": 2, "policystate": "BB"}), LOAD, AT)
    assert [r.policystate for r in upsert_by_key(first, later, ["policy_id"]).collect()] == ["BB"]


def test_coverage_hashes_raw_values_and_stores_filled_ones(spark):
    df = stg(spark, {"coveragecd": "c", "subline": None, "asl": "1"}, {"coveragecd": "c", "subline": None, "asl": "1"})
    rows = dims.dim_coverage(df, LOAD, AT).collect()
    assert len(rows) == 1 and rows[0].subline == "~"
    assert rows[0].coverage_id == hashlib.md5(b"c-_dbt_utils_surrogate_key_null_-1").hexdigest()
    assert dims.dim_coverage(df, LOAD, AT).schema.names == DIM_COVERAGE.names


def test_L17_null_parts_are_filled_before_the_anti_join(spark):
    df = stg(spark, {"limit1": None, "limit2": "b"}, {"limit1": None, "limit2": None}, {"limit1": "a", "limit2": "b"})
    stored = unknown_member(spark, "dim_limit", AT)
    first = stored.unionByName(dims.dim_limit(stored, df, LOAD, AT, 0))
    assert sorted((r.limit_id, r.limit1, r.limit2) for r in first.collect()) == [
        (0, "~", "~"), (1, "a", "b"), (2, "~", "b")
    ]
    assert dims.dim_limit(first, df, LOAD, AT, 2).count() == 0


def test_L18_an_initial_load_keeps_half_default_pairs(spark):
    load = LoadRange(high=20200110, initial=True)
    df = stg(spark, {"deductible1": Decimal(0), "deductible2": Decimal(5)}, {"deductible1": None, "deductible2": None})
    rows = dims.dim_deductible(empty(spark, DIM_DEDUCTIBLE), df, load, AT).collect()
    assert [(r.deductible_id, r.deductible1, r.deductible2) for r in rows] == [(1, Decimal("0.00"), Decimal("5.00"))]


def test_L19_deductibles_compare_exactly(spark):
    df = stg(spark, {"deductible1": Decimal("1.25"), "deductible2": Decimal("0")},
             {"deductible1": Decimal("1.00"), "deductible2": Decimal("0")})
    stored = unknown_member(spark, "dim_deductible", AT)
    assert dims.dim_deductible(stored, df, LOAD, AT).count() == 2


def test_sequence_follows_its_mark_not_the_table(spark):
    df = stg(spark, {"limit1": "a", "limit2": "b"})
    rows = dims.dim_limit(empty(spark, DIM_LIMIT), df, LOAD, AT, 41).collect()
    assert [r.limit_id for r in rows] == [42]


def test_keys_come_back_from_their_packed_form(spark):
    """hashes travel in 17 bytes, any other text unharmed."""
    from strataload.functions import packed, unpacked

    texts = ["0123456789abcdef" * 2, "0123456789ABCDEF" * 2, "Unknown", "", None, "\x01é", "g" * 32, "ab" * 15]
    rows = spark.createDataFrame([(t,) for t in texts], "k string").select("k", packed(F.col("k")).alias("p"))
    found = rows.select("k", unpacked(F.col("p")).alias("back"), F.length("p").alias("n")).collect()
    assert all(r.k == r.back for r in found) and found[0].n == 17
