"""Whole loads over a small hand-made source."""

from __future__ import annotations

from datetime import datetime
from decimal import Decimal

import pytest

from strataload.functions import LoadRange
from strataload.operators import checks
from strataload.plans.cycle import (
    FACT, SEQUENCES, LoadContext, clear_warehouse, next_range, register_views, run_load_cycle, tables,
)
from strataload.schemas import ORCHESTRATION_HISTORY, STG_PT
from strataload.sources.store import Store

T0, T1, T2, T3 = (datetime(2024, 1, d) for d in (1, 2, 3, 4))


def ctx(at):
    return LoadContext(at, at.replace(hour=2))


def source_row(transactiondate, policy, risk, effective, vin, amount, code="Renewal", limit1="a"):
    row = {
        "transactiondate": transactiondate, "accountingdate": transactiondate, "transactioncd": code,
        "transactioneffectivedate": int(effective.strftime("%Y%m%d")), "transactionsequence": 1,
        "policy_uniqueid": policy, "policynumber": f"P{policy}", "policystate": "CA", "coveragecd": "C",
        "subline": "S", "asl": "1", "limit1": limit1, "limit2": "b", "deductible1": Decimal(1),
        "deductible2": Decimal(2), "riskcd1": risk, "riskcd2": risk, "veh_effectivedate": effective,
        "drv_effectivedate": effective, "vin": vin, "gendercd": "F", "pointschargedterm": 0,
        "amount": Decimal(amount),
    }
    return tuple(row.get(n) for n in STG_PT.names)


ROWS = [
    source_row(20200103, 1, "1", datetime(2020, 1, 1), "A", 10),
    source_row(20200104, 1, "1", datetime(2020, 3, 1), "B", 20),
    source_row(20200105, 2, "1", datetime(2020, 1, 1), "A", 5, code="Strange", limit1=None),
    # Second load: a backdated change between A and B, and a new limit.
    source_row(20200110, 1, "1", datetime(2020, 2, 1), "C", 7, limit1="n"),
    source_row(20200210, 1, "1", datetime(2020, 2, 10), "C", 1),
]


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    store = Store(spark, str(tmp_path_factory.mktemp("dw")))
    source = spark.createDataFrame(ROWS, STG_PT)
    history = spark.createDataFrame([(20200105,), (20200115,)], ORCHESTRATION_HISTORY)
    clear_warehouse(store, ctx(T0), history)
    first = run_load_cycle(store, source, ctx(T1))
    second = run_load_cycle(store, source, ctx(T2))
    return store, source, first, second


def test_ranges_follow_the_history(loaded):
    store, source, first, second = loaded
    assert first.load == LoadRange(19000101, 20200105) and second.load == LoadRange(20200105, 20200115)
    assert next_range(store) is None
    assert run_load_cycle(store, source, ctx(T3)).load is None


def test_every_declared_check_passes(loaded):
    _, _, first, second = loaded
    for result in (first, second):
        assert result.failed_checks == {} and result.reconciled


def test_backdated_history_and_L26_stable_fact_keys(loaded):
    store = loaded[0]
    versions = {
        r.vin: (r.vehicle_id, r.valid_fromdate, r.valid_todate)
        for r in store.read("dim_vehicle").where("vehicle_uniqueid = '1_1'").collect()
    }
    assert [versions[v][1:] for v in "ACB"] == [
        (datetime(2020, 1, 1), datetime(2020, 2, 1)), (datetime(2020, 2, 1), datetime(2020, 3, 1)),
        (datetime(2020, 3, 1), datetime(3000, 12, 31)),
    ]
    facts = {int(r.amount): r for r in store.read_partitioned(FACT).collect()}
    assert sorted(facts) == [5, 7, 10, 20]
    assert [facts[a].vehicle_id for a in (10, 7, 20)] == [versions[v][0] for v in "ACB"]
    assert (facts[5].transaction_id, facts[5].limit_id, facts[7].limit_id) == (0, 0, 3)


def test_sequence_mark_and_logs(loaded):
    store = loaded[0]
    assert [tuple(r) for r in store.read(SEQUENCES).collect()] == [("dim_limit", 3)]
    log = sorted(map(tuple, store.read("orchestration_log").collect()))
    assert log == [(T1, 20200105, T1.replace(hour=2)), (T2, 20200115, T2.replace(hour=2))]
    operations = store.read("dbt_log")
    assert operations.count() == 16 and operations.where("enddate IS NULL").isEmpty()


def test_summary_of_the_second_load(loaded):
    _, _, _, second = loaded
    rows = {r.table_name: (r.cnt_records_on, r.total_cnt_records, r.latest_loaded_date) for r in second.summary.collect()}
    assert rows == {
        "dim_coverage": (1, 2, T2), "dim_deductible": (0, 2, T1), "dim_driver": (0, 3, T1), "dim_limit": (1, 4, T2),
        "dim_policy": (1, 3, T2), "dim_vehicle": (1, 5, T2), "fact_policytransaction": (1, 4, T2),
    }


def test_aggregate_holds_the_latest_month(loaded):
    store = loaded[0]
    rows = sorted((r.month_id, r.policy_id, int(r.metric), r.loaddate) for r in tables(store)["dummy_agg_table"].collect())
    assert rows == [(202001, 1, 37, T2), (202001, 2, 5, T2)]


def test_tables_and_views_are_open_to_sql(loaded, spark):
    store, source, _, second = loaded
    register_views(store, source, second.load)
    assert [tuple(r) for r in spark.sql("SELECT * FROM dummy_view_for_reporting").collect()] == [
        (202001, "CA", Decimal(42))
    ]
    assert [r.vin for r in spark.sql("SELECT vin FROM stg_vehicle").collect()] == ["C"]
    joined = spark.sql("SELECT v.vin FROM fact_policytransaction f JOIN dim_vehicle v USING (vehicle_id) WHERE f.amount = 7")
    assert [r.vin for r in joined.collect()] == ["C"]


def test_stages_can_be_left_out_and_an_open_load_is_retried(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    source = spark.createDataFrame(ROWS, STG_PT)
    clear_warehouse(store, ctx(T0), spark.createDataFrame([(20200105,)], ORCHESTRATION_HISTORY), load_defaults=False)
    from strataload.operators import control

    store.write("orchestration_log", control.orchestration_open(store.read("orchestration_log"), T1, 20200105))
    with pytest.raises(ValueError, match="'dim'"):
        run_load_cycle(store, source, ctx(T2), stages=frozenset({"dim"}))
    result = run_load_cycle(store, source, ctx(T2), stages=frozenset({"facts"}))
    assert result.load == LoadRange(19000101, 20200105) and result.reconciled is None
    facts = store.read_partitioned(FACT)
    assert facts.count() == 3 and facts.where("policy_id <> 0 OR vehicle_id <> 'Unknown'").isEmpty()
    assert store.read("dim_vehicle").isEmpty()
    # Without unknown members, the facts' default keys have no parent.
    assert "relationships:fact_policytransaction:policy_id" in checks.failures(tables(store))
