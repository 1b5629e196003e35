"""The same results in plain SQL, written apart from the operators, to check them by."""

from __future__ import annotations

import re

L0, L1, L2 = "2024-01-01 00:00:00", "2024-01-02 00:00:00", "2024-01-03 00:00:00"


def _staged(span: str, entity: str, key: str, when: str, columns: dict[str, str]) -> str:
    maxima = ", ".join(f"max({source}) AS {name}" for name, source in columns.items())
    return f"""
      SELECT md5(coalesce({entity}, '') || '|' || coalesce(strftime({when}, '%Y-%m-%d %H:%M:%S.%f'), '')) AS {key},
             {when} AS chg, {entity} AS entity, {maxima}
      FROM stg WHERE {span} GROUP BY {when}, {entity}"""


_VEHICLE = {c: c for c in ("vin", "model", "modelyr", "manufacturer", "estimatedannualdistance")}
_DRIVER = {
    "gendercd": "gendercd",
    "birthdate": "strftime(birthdate, '%Y-%m-%d')",
    "maritalstatuscd": "maritalstatuscd",
    "pointscharged": "CAST(pointschargedterm AS VARCHAR)",
}
_V_ID = "(CAST(policy_uniqueid AS VARCHAR) || '_' || riskcd1)"
_D_ID = "(CAST(policy_uniqueid AS VARCHAR) || '_' || riskcd2)"
FIRST = "transactiondate > 19000101 AND transactiondate <= 19970101"
SECOND = "transactiondate > 19970101 AND transactiondate <= 20991231"
ALL = "transactiondate > 19000101 AND transactiondate <= 20991231"


def _changed(columns: list[str], null_safe: bool = False) -> str:
    if null_safe:
        return "(NOT has_before OR " + " OR ".join(f"{c} IS DISTINCT FROM was_{c}" for c in columns) + ")"
    return "(" + " OR ".join(f"{c} <> coalesce(was_{c}, 'not_found')" for c in columns) + ")"


def _scd2(prefix: str, dim: str, staged: str, key: str, columns: list[str], stamp: str,
          null_safe: bool = False) -> dict[str, str]:
    """CTEs of one load: {prefix}_kept are the new versions, {prefix}_dim the dimension afterwards."""
    names = ", ".join(columns)
    was = ", ".join(f"lag({c}) OVER w AS was_{c}" for c in columns)
    return {
        f"{prefix}_kept": f"""
          SELECT {key}, chg, entity, {names} FROM (
            SELECT *, {was}, lag(true) OVER w IS NOT NULL AS has_before FROM (
              SELECT {key}, valid_fromdate AS chg, entity, {names}, 0 AS is_new FROM {dim}
              WHERE entity IN (SELECT entity FROM {staged})
              UNION ALL
              SELECT s.{key}, s.chg, s.entity, {", ".join("s." + c for c in columns)}, 1
              FROM {staged} s WHERE NOT EXISTS (SELECT 1 FROM {dim} d WHERE d.{key} = s.{key}))
            WINDOW w AS (PARTITION BY entity ORDER BY chg NULLS LAST, {key}))
          WHERE is_new = 1 AND {_changed(columns, null_safe)}""",
        f"{prefix}_dim": f"""
          SELECT {key}, valid_fromdate,
                 CASE WHEN entity IN (SELECT entity FROM {prefix}_kept)
                      THEN coalesce(lead(valid_fromdate) OVER
                             (PARTITION BY entity ORDER BY valid_fromdate NULLS LAST, {key}),
                           TIMESTAMP '3000-12-31 00:00:00')
                      ELSE valid_todate END AS valid_todate,
                 entity, {names}, loaddate
          FROM (SELECT {key}, valid_fromdate, valid_todate, entity, {names}, loaddate FROM {dim}
                UNION ALL
                SELECT {key}, chg, NULL, entity, {names}, TIMESTAMP '{stamp}' FROM {prefix}_kept)""",
    }


def _allocated(prefix: str, dim: str, span: str, id_col: str, pair: list[str], values: list[str],
               stamp: str) -> dict[str, str]:
    a, b = pair
    return {
        f"{prefix}_new": f"""
          SELECT * FROM (SELECT DISTINCT {values[0]} AS {a}, {values[1]} AS {b} FROM stg WHERE {span}) s
          WHERE NOT EXISTS (SELECT 1 FROM {dim} d WHERE d.{a} = s.{a} AND d.{b} = s.{b})""",
        f"{prefix}_all": f"""
          SELECT {id_col}, {a}, {b}, loaddate FROM {dim}
          UNION ALL
          SELECT (SELECT max({id_col}) FROM {dim}) + row_number() OVER (ORDER BY {a}, {b}), {a}, {b},
                 TIMESTAMP '{stamp}' FROM {prefix}_new""",
    }


def _policy(span: str, stamp: str) -> str:
    return f"""
      SELECT policy_uniqueid AS policy_id, policy_uniqueid, policynumber, effectivedate, expirationdate,
             inceptiondate, policystate, carriercd, companycd, TIMESTAMP '{stamp}' AS loaddate
      FROM (SELECT *, row_number() OVER (PARTITION BY policy_uniqueid ORDER BY transactionsequence DESC,
              policynumber, effectivedate, expirationdate, inceptiondate, policystate, carriercd, companycd) AS rn
            FROM stg WHERE {span}) WHERE rn = 1"""


def _coverage(span: str, stamp: str) -> str:
    text = " || '-' || ".join(
        f"coalesce({c}, '_dbt_utils_surrogate_key_null_')" for c in ("coveragecd", "subline", "asl"))
    return f"""
      SELECT DISTINCT md5({text}) AS coverage_id, coalesce(coveragecd, '~') AS coveragecd,
             coalesce(subline, '~') AS subline, coalesce(asl, '~') AS asl, TIMESTAMP '{stamp}' AS loaddate
      FROM stg WHERE {span}"""


def _merged(old: str, new: str, key: str) -> str:
    return f"SELECT * FROM {old} WHERE {key} NOT IN (SELECT {key} FROM {new}) UNION ALL SELECT * FROM {new}"


def _fact(span: str, stamp: str, n: int) -> str:
    return f"""
      SELECT md5(CAST(s.transactiondate AS VARCHAR)) AS policytransaction_id, s.transactiondate, s.accountingdate,
             coalesce(t.transaction_id, 0) AS transaction_id, s.transactioneffectivedate, s.transactionsequence,
             coalesce(p.policy_id, 0) AS policy_id, s.veh_effectivedate,
             coalesce(v.vehicle_id, 'Unknown') AS vehicle_id, coalesce(d.driver_id, 'Unknown') AS driver_id,
             coalesce(c.coverage_id, 'Unknown') AS coverage_id, coalesce(l.limit_id, 0) AS limit_id,
             coalesce(x.deductible_id, 0) AS deductible_id, s.amount, TIMESTAMP '{stamp}' AS loaddate
      FROM (SELECT *, {_V_ID} AS veh, {_D_ID} AS drv FROM stg WHERE {span}) s
      LEFT JOIN types t ON s.transactioncd = t.transactioncd
      LEFT JOIN policy{n} p ON s.policy_uniqueid = p.policy_uniqueid
      LEFT JOIN coverage{n} c ON s.coveragecd = c.coveragecd AND s.subline = c.subline AND s.asl = c.asl
      LEFT JOIN limit{n}_all l ON s.limit1 = l.limit1 AND s.limit2 = l.limit2
      LEFT JOIN deductible{n}_all x ON s.deductible1 = x.deductible1 AND s.deductible2 = x.deductible2
      LEFT JOIN driver{n}_dim d ON s.drv = d.entity
        AND s.drv_effectivedate >= d.valid_fromdate AND s.drv_effectivedate < d.valid_todate
      LEFT JOIN vehicle{n}_dim v ON s.veh = v.entity
        AND s.veh_effectivedate >= v.valid_fromdate AND s.veh_effectivedate < v.valid_todate"""


_V, _D = list(_VEHICLE), list(_DRIVER)
_LIMIT = ["coalesce(limit1, '~')", "coalesce(limit2, '~')"]
_DEDUCT = ["coalesce(deductible1, 0)", "coalesce(deductible2, 0)"]

CTES: dict[str, str] = {
    "stg": """
      SELECT CAST(strftime(l_shipdate, '%Y%m%d') AS INTEGER) AS transactiondate,
             CAST(strftime(l_shipdate, '%Y%m%d') AS INTEGER) AS accountingdate,
             CASE o_orderpriority WHEN '1-URGENT' THEN 'New Business' WHEN '2-HIGH' THEN 'Endorsement'
               WHEN '3-MEDIUM' THEN 'Renewal' WHEN '4-NOT SPECIFIED' THEN 'Cancellation'
               ELSE o_orderpriority END AS transactioncd,
             CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS transactioneffectivedate,
             l_linenumber AS transactionsequence, o_custkey + 1 AS policy_uniqueid,
             CAST(o_custkey AS VARCHAR) AS policynumber, CAST(o_orderdate AS DATE) AS effectivedate,
             CAST(o_orderdate AS DATE) AS expirationdate, CAST(o_orderdate AS DATE) AS inceptiondate,
             o_orderstatus AS policystate, substr(o_orderpriority, 1, 1) AS carriercd, l_linestatus AS companycd,
             p_brand AS coveragecd, p_type AS subline, CAST(p_size AS VARCHAR) || late AS asl,
             nullif(l_returnflag, 'N') || late AS limit1, l_linestatus || late AS limit2,
             CAST(round(l_discount * 100) AS DECIMAL(18,2)) + CASE late WHEN 'x' THEN 100 ELSE 0 END AS deductible1,
             CAST(round(l_tax * 100) AS DECIMAL(18,2)) AS deductible2,
             CAST(l_partkey % 3 AS VARCHAR) AS riskcd1, CAST(l_suppkey % 2 AS VARCHAR) AS riskcd2,
             o_orderdate AS veh_effectivedate, o_orderdate AS drv_effectivedate,
             l_returnflag AS vin, l_linestatus AS model, o_orderstatus AS modelyr,
             nullif(l_returnflag, 'R') AS manufacturer,
             CASE WHEN l_quantity > 25 THEN '1' ELSE '0' END AS estimatedannualdistance,
             l_returnflag AS gendercd, CAST(NULL AS DATE) AS birthdate, l_linestatus AS maritalstatuscd,
             CASE WHEN l_linenumber > 4 THEN 1 ELSE 0 END AS pointschargedterm,
             CAST(l_extendedprice AS DECIMAL(18,2)) AS amount
      FROM (SELECT *, CASE WHEN l_shipdate >= TIMESTAMP '1998-01-01' AND l_quantity > 25 THEN 'x' ELSE '' END AS late
            FROM lineitem)
      JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey""",
    "types": """
      SELECT * FROM (VALUES (0, 'Unknown'), (1, 'Unapply'), (2, 'Non-Renewal Rescind'), (3, 'Reinstatement'),
        (4, 'Renewal'), (5, 'New Business'), (6, 'Cancellation'), (7, 'Endorsement'), (8, 'Non-Renewal'),
        (9, 'Commission Reversal')) t(transaction_id, transactioncd)""",
    "sv1": _staged(FIRST, _V_ID, "vehicle_id", "veh_effectivedate", _VEHICLE),
    "sv2": _staged(SECOND, _V_ID, "vehicle_id", "veh_effectivedate", _VEHICLE),
    "sv": _staged(ALL, _V_ID, "vehicle_id", "veh_effectivedate", _VEHICLE),
    "sd1": _staged(FIRST, _D_ID, "driver_id", "drv_effectivedate", _DRIVER),
    "sd2": _staged(SECOND, _D_ID, "driver_id", "drv_effectivedate", _DRIVER),
    "sd": _staged(ALL, _D_ID, "driver_id", "drv_effectivedate", _DRIVER),
    "vehicle0": f"""
      SELECT 'Unknown' AS vehicle_id, TIMESTAMP '1900-01-01 00:00:00' AS valid_fromdate,
             TIMESTAMP '3000-12-31 00:00:00' AS valid_todate, 'Unknown' AS entity, '~' AS vin, '~' AS model,
             '~' AS modelyr, '~' AS manufacturer, '0' AS estimatedannualdistance, TIMESTAMP '{L0}' AS loaddate""",
    "driver0": f"""
      SELECT 'Unknown' AS driver_id, TIMESTAMP '1900-01-01 00:00:00' AS valid_fromdate,
             TIMESTAMP '3000-01-01 00:00:00' AS valid_todate, 'Unknown' AS entity, '~' AS gendercd,
             '1900-01-01' AS birthdate, '~' AS maritalstatuscd, '0' AS pointscharged, TIMESTAMP '{L0}' AS loaddate""",
    **_scd2("vehicle1", "vehicle0", "sv1", "vehicle_id", _V, L1),
    **_scd2("vehicle2", "vehicle1_dim", "sv2", "vehicle_id", _V, L2),
    **_scd2("vehsafe1", "vehicle0", "sv1", "vehicle_id", _V, L1, null_safe=True),
    **_scd2("vehsafe2", "vehsafe1_dim", "sv2", "vehicle_id", _V, L2, null_safe=True),
    **_scd2("driver1", "driver0", "sd1", "driver_id", _D, L1),
    **_scd2("driver2", "driver1_dim", "sd2", "driver_id", _D, L2),
    "ev_new": """SELECT CAST(event_id AS VARCHAR) AS event_key, ts AS chg, CAST(user_id AS VARCHAR) AS entity, event_type
      FROM events WHERE ts >= TIMESTAMP '2024-01-16'""",
    "ev_old": """SELECT CAST(event_id AS VARCHAR) AS event_key, ts AS chg, CAST(user_id AS VARCHAR) AS entity, event_type
      FROM events WHERE ts < TIMESTAMP '2024-01-16'""",
    "event0": f"""SELECT '' AS event_key, TIMESTAMP '1900-01-01' AS valid_fromdate, TIMESTAMP '1900-01-01' AS valid_todate,
      '' AS entity, '' AS event_type, TIMESTAMP '{L0}' AS loaddate WHERE false""",
    **_scd2("event1", "event0", "ev_new", "event_key", ["event_type"], L1),
    **_scd2("event2", "event1_dim", "ev_old", "event_key", ["event_type"], L2),
    "kind_new": """SELECT CAST(event_id AS VARCHAR) AS event_key, ts AS chg, event_type AS entity, CAST(user_id AS VARCHAR) AS user_key
      FROM events WHERE ts >= TIMESTAMP '2024-01-16'""",
    "kind_old": """SELECT CAST(event_id AS VARCHAR) AS event_key, ts AS chg, event_type AS entity, CAST(user_id AS VARCHAR) AS user_key
      FROM events WHERE ts < TIMESTAMP '2024-01-16'""",
    "kind0": f"""SELECT '' AS event_key, TIMESTAMP '1900-01-01' AS valid_fromdate, TIMESTAMP '1900-01-01' AS valid_todate,
      '' AS entity, '' AS user_key, TIMESTAMP '{L0}' AS loaddate WHERE false""",
    **_scd2("kind1", "kind0", "kind_new", "event_key", ["user_key"], L1),
    **_scd2("kind2", "kind1_dim", "kind_old", "event_key", ["user_key"], L2),
    "policy0": f"""SELECT CAST(0 AS BIGINT) AS policy_id, CAST(0 AS BIGINT) AS policy_uniqueid,
      'Unknown' AS policynumber, DATE '1900-01-01' AS effectivedate, DATE '2900-01-01' AS expirationdate,
      DATE '1900-01-01' AS inceptiondate, '~' AS policystate, '~' AS carriercd, '~' AS companycd,
      TIMESTAMP '{L0}' AS loaddate""",
    "policy_b1": _policy(FIRST, L1),
    "policy1": _merged("policy0", "policy_b1", "policy_id"),
    "policy_b2": _policy(SECOND, L2),
    "policy2": _merged("policy1", "policy_b2", "policy_id"),
    "coverage0": f"""SELECT 'Unknown' AS coverage_id, '~' AS coveragecd, '~' AS subline, '~' AS asl,
      TIMESTAMP '{L0}' AS loaddate""",
    "coverage_b1": _coverage(FIRST, L1),
    "coverage1": _merged("coverage0", "coverage_b1", "coverage_id"),
    "coverage_b2": _coverage(SECOND, L2),
    "coverage2": _merged("coverage1", "coverage_b2", "coverage_id"),
    "limit0": f"SELECT CAST(0 AS BIGINT) AS limit_id, '~' AS limit1, '~' AS limit2, TIMESTAMP '{L0}' AS loaddate",
    **_allocated("limit1", "limit0", FIRST, "limit_id", ["limit1", "limit2"], _LIMIT, L1),
    **_allocated("limit2", "limit1_all", SECOND, "limit_id", ["limit1", "limit2"], _LIMIT, L2),
    "deductible0": f"""SELECT CAST(0 AS BIGINT) AS deductible_id, CAST(0 AS DECIMAL(18,2)) AS deductible1,
      CAST(0 AS DECIMAL(18,2)) AS deductible2, TIMESTAMP '{L0}' AS loaddate""",
    **_allocated("deductible1", "deductible0", FIRST, "deductible_id", ["deductible1", "deductible2"], _DEDUCT, L1),
    **_allocated("deductible2", "deductible1_all", SECOND, "deductible_id", ["deductible1", "deductible2"],
                 _DEDUCT, L2),
    "fact1": _fact(FIRST, L1, 1),
    "fact2": _fact(SECOND, L2, 2),
    "fact": "SELECT * FROM fact1 UNION ALL SELECT * FROM fact2",
    "agg1": f"""SELECT accountingdate // 100 AS agg_id, accountingdate // 100 AS month_id, policy_id,
      sum(amount) AS metric, TIMESTAMP '{L1}' AS loaddate FROM fact1
      WHERE accountingdate // 100 = (SELECT max(accountingdate // 100) FROM fact1) GROUP BY 1, 2, 3""",
    "agg2": f"""SELECT * FROM agg1 WHERE month_id <> (SELECT max(accountingdate // 100) FROM fact)
      UNION ALL
      SELECT accountingdate // 100, accountingdate // 100, policy_id, sum(amount), TIMESTAMP '{L2}' FROM fact
      WHERE accountingdate // 100 = (SELECT max(accountingdate // 100) FROM fact) GROUP BY 1, 2, 3""",
    "loads": """SELECT max(CAST(strftime(l_shipdate, '%Y%m%d') AS INTEGER)) AS transactiondate,
        max(l_shipdate) + INTERVAL 23 HOUR AS loaddate,
        CASE WHEN max(l_shipdate) < TIMESTAMP '2001-10-01' THEN max(l_shipdate) + INTERVAL 24 HOUR END AS endloaddate
      FROM lineitem GROUP BY date_trunc('month', l_shipdate)""",
    "ops": """SELECT date_trunc('second', ts) AS startdate, event_type AS operation,
        CASE WHEN value >= 5 THEN date_trunc('second', ts) + INTERVAL 1 MINUTE END AS enddate FROM events""",
}


def _text(column: str, name: str | None = None) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S') AS {name or column.split('.')[-1]}"


def _day(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d') AS {column}"


def _money(column: str) -> str:
    return f"CAST({column} AS DOUBLE) AS {column}"


def with_ctes(select: str) -> str:
    """Prefix a SELECT with the CTEs it uses, directly or through others, in order."""
    needed: set[str] = set()

    def visit(sql: str) -> None:
        for name in set(re.findall(r"\b[a-z]\w*\b", sql)) & CTES.keys():
            if name not in needed and re.search(rf"\b(?:FROM|JOIN)\s+{name}\b", sql):
                needed.add(name)
                visit(CTES[name])

    visit(select)
    if not needed:
        return select
    parts = [f"{name} AS MATERIALIZED ({sql})" for name, sql in CTES.items() if name in needed]
    return "WITH " + ",\n".join(parts) + "\n" + select


def _dim_rows(cte: str, key: str, entity: str, columns: list[str]) -> str:
    return (f"SELECT {key}, {_text('valid_fromdate')}, {_text('valid_todate')}, entity AS {entity}, "
            f"{', '.join(columns)}, {_text('loaddate')} FROM {cte}")


_POLICY_ROWS = f"""SELECT policy_id, policy_uniqueid, policynumber, {_day('effectivedate')}, {_day('expirationdate')},
  {_day('inceptiondate')}, policystate, carriercd, companycd, {_text('loaddate')} FROM policy2"""
_FACT_COLUMNS = f"""policytransaction_id, transactiondate, accountingdate, transaction_id, transactioneffectivedate,
  transactionsequence, policy_id, {_text('veh_effectivedate')}, vehicle_id, driver_id, coverage_id, limit_id,
  deductible_id, {_money('amount')}, {_text('loaddate')}"""


def _summary(tables: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{name}' AS table_name, count(*) FILTER (WHERE loaddate = TIMESTAMP '{L2}') AS cnt_records_on,
        '{L2}' AS loaddate, count(*) AS total_cnt_records, {_text('max(loaddate)', 'latest_loaded_date')} FROM {cte}"""
        for name, cte in tables.items())


_PIT = f"""SELECT coalesce(v.vehicle_id, 'Unknown') AS vehicle_id, count(*) AS n_rows,
  CAST(sum(s.amount) AS DOUBLE) AS amount
  FROM (SELECT *, {_V_ID} AS veh FROM stg) s LEFT JOIN {{dim}} v ON s.veh = v.entity
    AND s.veh_effectivedate >= v.valid_fromdate AND s.veh_effectivedate < v.valid_todate GROUP BY 1"""
_WAS = ", ".join(f"lag({c}) OVER w AS was_{c}" for c in _V)
_FILES = f"transactiondate, policy_uniqueid, transactioncd, limit1, {_money('amount')}"
_CYCLE = """SELECT strftime(loaddate, '%Y-%m-%d %H:%M:%S') AS loaddate, count(*) AS n_rows,
  CAST(sum(amount) AS DOUBLE) AS amount, count(DISTINCT policy_id) AS n_policies,
  count(DISTINCT vehicle_id) AS n_vehicle_versions, count(DISTINCT driver_id) AS n_driver_versions,
  count(*) FILTER (WHERE limit_id = 0) AS n_unknown_limits,
  CAST(sum(deductible_id) AS BIGINT) AS sum_deductible_ids, CAST(sum(limit_id) AS BIGINT) AS sum_limit_ids
  FROM fact GROUP BY 1"""

SELECTS: dict[str, str] = {
    "incremental_filter": f"SELECT transactiondate, policy_uniqueid, transactionsequence, {_money('amount')} FROM stg WHERE {SECOND}",
    "full_load_filter": f"SELECT transactiondate, policy_uniqueid, transactionsequence, {_money('amount')} FROM stg WHERE transactiondate = 19970102",
    "latest_load_rows": f"SELECT transactiondate, policy_uniqueid, '{L2}' AS loaddate FROM stg WHERE {SECOND}",
    "surrogate_key": """SELECT policy_uniqueid, md5(CAST(transactiondate AS VARCHAR)) AS date_key,
        md5(coalesce(limit1, '_dbt_utils_surrogate_key_null_') || '-' || coalesce(limit2, '_dbt_utils_surrogate_key_null_')
            || '-' || CAST(policy_uniqueid AS VARCHAR)) AS limit_key FROM stg""",
    "month_of_yyyymmdd": """SELECT CAST(substr(CAST(transactiondate AS VARCHAR), 1, 6) AS INTEGER) AS month_id,
        count(*) AS n_rows, CAST(sum(amount) AS DOUBLE) AS amount FROM stg GROUP BY 1""",
    "stage_vehicle": f"SELECT vehicle_id, {_text('chg', 'transactioneffectivedate')}, entity AS vehicle_uniqueid, {', '.join(_V)} FROM sv",
    "stage_driver": f"SELECT driver_id, {_text('chg', 'transactioneffectivedate')}, entity AS driver_uniqueid, {', '.join(_D)} FROM sd",
    "lead_valid_to": """SELECT event_id, strftime(coalesce(lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id),
        TIMESTAMP '3000-12-31 00:00:00'), '%Y-%m-%d %H:%M:%S.%f') AS valid_todate FROM events""",
    "lag_change_flags": f"""SELECT vehicle_id, CAST(coalesce({_changed(_V)}, false) AS INTEGER) AS is_change,
        CAST({_changed(_V, True)} AS INTEGER) AS is_change_null_safe
        FROM (SELECT *, {_WAS}, lag(true) OVER w IS NOT NULL AS has_before FROM sv
              WINDOW w AS (PARTITION BY entity ORDER BY chg NULLS LAST, vehicle_id))""",
    "row_number_ids": """SELECT vehicle_id, row_number() OVER (ORDER BY entity, chg) AS version_number FROM sv""",
    "scd2_new_rows_anti": f"""SELECT vehicle_id, {_text('chg', 'transactioneffectivedate')}, entity AS vehicle_uniqueid
        FROM sv2 WHERE vehicle_id NOT IN (SELECT vehicle_id FROM vehicle1_dim)""",
    "semi_affected_entities": f"""SELECT vehicle_id, entity AS vehicle_uniqueid, {_text('valid_fromdate')}
        FROM vehicle1_dim WHERE entity IN (SELECT entity FROM sv2)""",
    "not_exists_new_members": f"""SELECT DISTINCT coveragecd, subline, asl FROM stg WHERE {SECOND}
        AND (coveragecd, subline, asl) NOT IN (SELECT (coveragecd, subline, asl) FROM coverage1)""",
    "scd2_changes": f"""SELECT vehicle_id, {_text('chg', 'valid_fromdate')}, entity AS vehicle_uniqueid, {', '.join(_V)},
        '{L2}' AS loaddate FROM vehicle2_kept""",
    "scd2_close_intervals": f"""SELECT vehicle_id, {_text('valid_fromdate')},
        strftime(CASE WHEN entity IN (SELECT entity FROM sv2)
          THEN coalesce(lead(valid_fromdate) OVER (PARTITION BY entity ORDER BY valid_fromdate, vehicle_id),
               TIMESTAMP '3000-12-31 00:00:00')
          ELSE TIMESTAMP '3000-12-31 00:00:00' END, '%Y-%m-%d %H:%M:%S') AS valid_todate FROM vehicle1_dim""",
    "scd2_initial": _dim_rows("vehicle1_dim", "vehicle_id", "vehicle_uniqueid", _V),
    "scd2_initial_driver": _dim_rows("driver1_dim", "driver_id", "driver_uniqueid", _D),
    "scd2_incremental": _dim_rows("vehicle2_dim", "vehicle_id", "vehicle_uniqueid", _V),
    "scd2_incremental_driver": _dim_rows("driver2_dim", "driver_id", "driver_uniqueid", _D),
    "scd2_incremental_null_safe": _dim_rows("vehsafe2_dim", "vehicle_id", "vehicle_uniqueid", _V),
    "scd2_backdated": f"""SELECT event_key, strftime(valid_fromdate, '%Y-%m-%d %H:%M:%S.%f') AS valid_fromdate,
        strftime(valid_todate, '%Y-%m-%d %H:%M:%S.%f') AS valid_todate, entity AS user_key, event_type,
        {_text('loaddate')} FROM event2_dim""",
    "scd2_incremental_hot": f"""SELECT event_key, strftime(valid_fromdate, '%Y-%m-%d %H:%M:%S.%f') AS valid_fromdate,
        strftime(valid_todate, '%Y-%m-%d %H:%M:%S.%f') AS valid_todate, entity AS kind, user_key,
        {_text('loaddate')} FROM kind2_dim""",
    "point_in_time_hot": """SELECT coalesce(v.event_key, 'Unknown') AS event_key, count(*) AS n_rows,
        CAST(sum(e.event_id) AS BIGINT) AS sum_event_ids FROM events e
        LEFT JOIN kind2_dim v ON e.event_type = v.entity AND e.ts >= v.valid_fromdate AND e.ts < v.valid_todate GROUP BY 1""",
    "scd2_bucketed": _dim_rows("vehicle2_dim", "vehicle_id", "vehicle_uniqueid", _V),
    "zone_map": f"""SELECT transactiondate // 100 AS part, count(*) AS n_rows, count(*) FILTER (WHERE load = newest) AS n_newest,
        {_text('min(load)', 'min_loaddate')}, {_text('max(load)', 'max_loaddate')},
        min(accountingdate) AS min_accountingdate, max(accountingdate) AS max_accountingdate
        FROM (SELECT *, max(load) OVER (PARTITION BY transactiondate // 100) AS newest FROM (
          SELECT *, CASE WHEN {FIRST} THEN TIMESTAMP '{L1}' ELSE TIMESTAMP '{L2}' END AS load FROM stg)) GROUP BY 1""",
    "zone_latest_month": """SELECT policy_uniqueid, count(*) AS n_rows, CAST(sum(amount) AS DOUBLE) AS amount FROM stg
        WHERE accountingdate // 100 = (SELECT max(accountingdate) // 100 FROM stg) GROUP BY 1""",
    "observed_load_summary": _summary({"dim_coverage": "coverage2", "dim_vehicle": "vehicle2_dim"}) + f""" UNION ALL
        SELECT 'movements', count(*) FILTER (WHERE {SECOND}), '{L2}', count(*), '{L2}' FROM stg""",
    "oplog_folded": f"""SELECT {_text('startdate')}, operation, {_text('max(enddate)', 'enddate')} FROM ops
        GROUP BY ops.startdate, operation""",
    "stage_csv_load_once": f"SELECT {_FILES} FROM stg",
    "seed_from_csv": """SELECT n_nationkey, n_name, count(c_custkey) AS n_customers FROM nation
        LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY 1, 2""",
    "lookup_single_key": """SELECT coalesce(t.transaction_id, 0) AS transaction_id, coalesce(p.policy_id, 0) AS policy_id,
        count(*) AS n_rows, CAST(sum(s.amount) AS DOUBLE) AS amount FROM stg s
        LEFT JOIN types t ON s.transactioncd = t.transactioncd
        LEFT JOIN policy2 p ON s.policy_uniqueid = p.policy_uniqueid GROUP BY 1, 2""",
    "lookup_composite_key": """SELECT coalesce(c.coverage_id, 'Unknown') AS coverage_id, coalesce(l.limit_id, 0) AS limit_id,
        count(*) AS n_rows, CAST(sum(s.amount) AS DOUBLE) AS amount FROM stg s
        LEFT JOIN coverage2 c ON s.coveragecd = c.coveragecd AND s.subline = c.subline AND s.asl = c.asl
        LEFT JOIN limit2_all l ON s.limit1 = l.limit1 AND s.limit2 = l.limit2 GROUP BY 1, 2""",
    "point_in_time_join": _PIT.format(dim="vehicle2_dim"),
    "point_in_time_timeline": _PIT.format(dim="vehicle2_dim"),
    "seed_transaction_types": """SELECT t.transaction_id, t.transactioncd, coalesce(n_rows, 0) AS n_rows,
        coalesce(amount, 0) AS amount FROM types t
        LEFT JOIN (SELECT coalesce(t.transactioncd, 'Unknown') AS transactioncd, count(*) AS n_rows,
                     CAST(sum(amount) AS DOUBLE) AS amount
                   FROM stg s LEFT JOIN types t ON s.transactioncd = t.transactioncd GROUP BY 1) s
        ON t.transactioncd = s.transactioncd""",
    "unknown_members": f"""
        SELECT 'dim_coverage' AS dim, 'Unknown|~|~|~' AS member, count(*) FILTER (WHERE coverage_id = 'Unknown') AS n_facts FROM fact
        UNION ALL SELECT 'dim_deductible', '0|0.00|0.00', count(*) FILTER (WHERE deductible_id = 0) FROM fact
        UNION ALL SELECT 'dim_driver', 'Unknown|1900-01-01 00:00:00|3000-01-01 00:00:00|Unknown|~|1900-01-01|~|0',
          count(*) FILTER (WHERE driver_id = 'Unknown') FROM fact
        UNION ALL SELECT 'dim_limit', '0|~|~', count(*) FILTER (WHERE limit_id = 0) FROM fact
        UNION ALL SELECT 'dim_policy', '0|0|Unknown|1900-01-01|2900-01-01|1900-01-01|~|~|~',
          count(*) FILTER (WHERE policy_id = 0) FROM fact
        UNION ALL SELECT 'dim_vehicle', 'Unknown|1900-01-01 00:00:00|3000-12-31 00:00:00|Unknown|~|~|~|~|0',
          count(*) FILTER (WHERE vehicle_id = 'Unknown') FROM fact""",
    "dim_policy": _POLICY_ROWS,
    "dim_coverage": f"SELECT coverage_id, coveragecd, subline, asl, {_text('loaddate')} FROM coverage2",
    "dim_deductible": f"SELECT deductible_id, {_money('deductible1')}, {_money('deductible2')}, {_text('loaddate')} FROM deductible2_all",
    "dim_limit": f"SELECT limit_id, limit1, limit2, {_text('loaddate')} FROM limit2_all",
    "allocate_ids": f"""SELECT coveragecd, subline, asl, row_number() OVER (ORDER BY coveragecd, subline, asl) AS member_id
        FROM (SELECT DISTINCT coveragecd, subline, asl FROM stg WHERE {FIRST})
        UNION ALL
        SELECT coveragecd, subline, asl, (SELECT count(*) FROM (SELECT DISTINCT coveragecd, subline, asl FROM stg WHERE {FIRST}))
          + row_number() OVER (ORDER BY coveragecd, subline, asl)
        FROM (SELECT DISTINCT coveragecd, subline, asl FROM stg WHERE {SECOND}
              EXCEPT SELECT DISTINCT coveragecd, subline, asl FROM stg WHERE {FIRST})""",
    "upsert_by_key": f"""
        SELECT c_custkey, c_name, c_acctbal, '{L1}' AS loaddate FROM customer
        WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)
        UNION ALL
        SELECT o_custkey, 'seen', max(o_totalprice), '{L2}' FROM orders GROUP BY o_custkey
        UNION ALL SELECT 1000000000 + s_suppkey, s_name, s_acctbal, '{L2}' FROM supplier""",
    "sync_all_columns": """SELECT c_custkey, c_name, CAST(NULL AS VARCHAR) AS c_segment,
        CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS DOUBLE) AS c_acctbal FROM customer""",
    "fact_reload_idempotent": """SELECT transactiondate, count(*) AS n_rows, CAST(sum(amount) AS DOUBLE) AS amount
        FROM stg GROUP BY 1""",
    "fact_build": f"SELECT {_FACT_COLUMNS} FROM fact",
    "reconcile_staging_fact": """SELECT a.n AS cnt_in_staging, b.n AS cnt_in_fact, CAST(a.amount AS DOUBLE) AS sum_amount_in_staging,
        CAST(b.amount AS DOUBLE) AS sum_amount_in_fact
        FROM (SELECT count(*) AS n, sum(amount) AS amount FROM stg WHERE """ + SECOND + """) a,
             (SELECT count(*) AS n, sum(amount) AS amount FROM fact2) b""",
    "agg_latest_month": f"SELECT agg_id, month_id, policy_id, {_money('metric')}, {_text('loaddate')} FROM agg2",
    "report_by_state": """SELECT month_id AS year_month, policystate AS statecd, CAST(sum(metric) AS DOUBLE) AS metric
        FROM agg2 a JOIN policy2 p ON a.policy_id = p.policy_id GROUP BY 1, 2""",
    "latest_loaded_date": """SELECT coalesce(max(transactiondate), 19000101) AS transactiondate FROM loads
        WHERE loaddate = (SELECT max(loaddate) FROM loads WHERE endloaddate IS NOT NULL)""",
    "next_cutoff": """SELECT min(CAST(strftime(l_shipdate, '%Y%m%d') AS INTEGER)) AS transactiondate FROM lineitem
        WHERE CAST(strftime(l_shipdate, '%Y%m%d') AS INTEGER) > (SELECT max(transactiondate) FROM loads
          WHERE loaddate = (SELECT max(loaddate) FROM loads WHERE endloaddate IS NOT NULL))""",
    "orchestration_open": f"""SELECT {_text('loaddate')}, transactiondate, {_text('endloaddate')} FROM loads
        UNION ALL SELECT '{L1}', 20991231, NULL""",
    "orchestration_close": f"""SELECT {_text('loaddate')}, transactiondate,
        CASE WHEN loaddate = (SELECT max(loaddate) FROM loads) THEN '{L2}'
             ELSE strftime(endloaddate, '%Y-%m-%d %H:%M:%S') END AS endloaddate FROM loads""",
    "oplog_open": f"""SELECT {_text('startdate')}, operation, {_text('enddate')} FROM ops
        UNION ALL SELECT '2024-06-01 12:00:00', 'load_scd2: dim_vehicle', NULL""",
    "oplog_close": f"""SELECT {_text('startdate')}, operation,
        CASE WHEN operation = 'click' AND enddate IS NULL
              AND startdate = (SELECT max(startdate) FROM ops WHERE operation = 'click' AND enddate IS NULL)
             THEN '2024-06-01 12:00:00' ELSE strftime(enddate, '%Y-%m-%d %H:%M:%S') END AS enddate FROM ops""",
    "daily_load_summary": _summary({
        "dim_coverage": "coverage2", "dim_deductible": "deductible2_all", "dim_driver": "driver2_dim",
        "dim_limit": "limit2_all", "dim_policy": "policy2", "dim_vehicle": "vehicle2_dim",
        "fact_policytransaction": "fact"}),
    "test_unique": "SELECT l_orderkey, count(*) AS n_records FROM lineitem WHERE l_orderkey IS NOT NULL GROUP BY 1 HAVING count(*) > 1",
    "test_not_null": f"SELECT transactiondate, limit2, {_money('amount')} FROM stg WHERE limit1 IS NULL",
    "test_unique_combination": "SELECT l_orderkey, l_linenumber, count(*) AS n_records FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
    "test_relationships": """SELECT vehicle_uniqueid, count(*) AS n_records FROM
        (SELECT """ + _V_ID + """ AS vehicle_uniqueid FROM stg) s
        WHERE vehicle_uniqueid NOT IN (SELECT entity FROM vehicle1_dim) GROUP BY 1""",
    "test_scoped_latest": f"SELECT transactiondate, limit2, {_money('amount')} FROM stg WHERE {SECOND} AND limit1 IS NULL",
    "export_range_csv": f"SELECT {_FILES} FROM stg WHERE {SECOND}",
    "stage_csv_roundtrip": f"SELECT {_FILES} FROM stg",
    "full_refresh_dim": f"""SELECT coverage_id, coveragecd, subline, asl, {_text('loaddate')} FROM coverage0
        UNION ALL SELECT DISTINCT md5(coveragecd || '-' || subline || '-' || asl), coveragecd, subline, asl, '{L2}'
        FROM stg WHERE transactiondate = 19970102""",
    "load_cycle_two_batches": _CYCLE,
}


def oracle_sql() -> dict[str, str]:
    return {name: with_ctes(select) for name, select in SELECTS.items()}
