"""Staging views: one row per entity and change time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataload.functions import LoadRange, entity_id, iso_date, version_key
from strataload.schemas import DRIVER, STAMP, STG_DRIVER, STG_VEHICLE, VEHICLE, Scd2Spec, typed


def stage_entity(
    stg: DataFrame,
    load: LoadRange,
    spec: Scd2Spec,
    id_parts: list[str],
    change: str,
    attributes: dict[str, Column],
) -> DataFrame:
    """Rows of the range collapsed to one per (entity, change time).

    Conflicting attributes are settled by taking the largest value of each column
    on its own. The maxima are combined on the map side, so a hot entity sends one
    row per task and change time. The hashed key is made after the collapse.
    """
    grouped = (
        load.rows(stg)
        .groupBy(entity_id(*id_parts).alias(spec.entity), F.col(change).cast(STAMP).alias(spec.change))
        .agg(*[F.max(value).alias(name) for name, value in attributes.items()])
    )
    return grouped.withColumn(spec.key, version_key(F.col(spec.entity), F.col(spec.change)))


def stage_vehicle(stg: DataFrame, load: LoadRange) -> DataFrame:
    attributes = {name: F.col(name) for name in VEHICLE.tracked}
    staged = stage_entity(stg, load, VEHICLE, ["policy_uniqueid", "riskcd1"], "veh_effectivedate", attributes)
    return typed(staged, STG_VEHICLE)


def stage_driver(stg: DataFrame, load: LoadRange) -> DataFrame:
    attributes = {
        "gendercd": F.col("gendercd"),
        "birthdate": iso_date(F.col("birthdate")),
        "maritalstatuscd": F.col("maritalstatuscd"),
        "pointscharged": F.col("pointschargedterm").cast("string"),
    }
    staged = stage_entity(stg, load, DRIVER, ["policy_uniqueid", "riskcd2"], "drv_effectivedate", attributes)
    return typed(staged, STG_DRIVER)
