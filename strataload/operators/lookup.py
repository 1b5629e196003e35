"""Finding dimension keys for fact rows."""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataload.operators.skew import IS_HOT, SkewPolicy, hot_keys, marked, profile
from strataload.operators.timeline import Timeline
from strataload.schemas import STAMP, UNKNOWN_KEY, Scd2Spec
from strataload.operators.scd2 import FROM, TO, with_key, without_key
from strataload.sources.scratch import settle

_FOUND, _PROBE = "_found", "_probe"


def lookup(
    facts: DataFrame, dim: DataFrame, on: dict[str, str], take: str, default: Any, small: bool = False
) -> DataFrame:
    """Left join on equal columns, ``default`` where nothing matches.

    ``on`` maps fact columns to dimension columns. Sizes are known when the join
    runs: adaptive execution broadcasts a dimension below the broadcast limit and
    otherwise splits hot fact keys. ``small`` is only for a dimension of fixed size.
    """
    side = dim.select(*[F.col(d).alias(f"_{d}") for d in on.values()], F.col(take).alias(_FOUND))
    if small:
        side = F.broadcast(side)
    condition = [F.col(f) == F.col(f"_{d}") for f, d in on.items()]
    joined = facts.join(side, condition, "left")
    return joined.withColumn(take, F.coalesce(_FOUND, F.lit(default))).drop(_FOUND, *[f"_{d}" for d in on.values()])


def point_in_time_lookup(
    facts: DataFrame,
    dim: DataFrame,
    spec: Scd2Spec,
    entity: Column,
    at: Column,
    default: str = UNKNOWN_KEY,
    policy: SkewPolicy = SkewPolicy(),
) -> DataFrame:
    """The version in force at ``at``: same entity and valid_from <= at < valid_to.

    The version that began last decides: where versions of an entity overlap, the older
    one ends as the newer begins. With few versions per entity this is an equi-join on the
    entity that tests the range per candidate; adaptive execution splits hot entities on
    the fact side. An entity of more than ``versions_per_probe`` versions would meet every
    one of its facts with every version, so for such entities alone the answer is found per
    distinct (entity, time) on the timeline, in linear work, and joined back by equality.
    """
    probed = facts.withColumns({_PROBE: entity, "_at": at})
    versions = dim.select(
        F.col(spec.entity).alias("_entity"), F.col(FROM).alias("_from"), F.col(TO).alias("_to"),
        without_key(spec).alias(_FOUND),
    ).where(F.col("_entity").isNotNull() & (F.col("_from") < F.col("_to")))
    entities = profile(versions, "_entity")
    if entities.largest <= policy.versions_per_probe:
        joined = _in_force(probed, versions)
    else:
        busy = hot_keys(versions, "_entity", policy.versions_per_probe)
        if busy.count() == entities.keys:  # no version is left for the other way
            joined = _on_timeline(probed, versions, policy)
        else:
            versions, probed = marked(versions, "_entity", busy), marked(probed, _PROBE, busy)
            is_busy, others = F.col(IS_HOT), F.col(IS_HOT).isNull()
            joined = _on_timeline(probed.where(is_busy), versions.where(is_busy), policy)
            rest = _in_force(probed.where(others), versions.where(others).drop(IS_HOT))
            joined = joined.unionByName(rest).drop(IS_HOT)
    key = F.when(F.col("_start").isNotNull(), with_key(spec, F.col(_FOUND), F.col(_PROBE), F.col("_start")))
    return joined.withColumn(spec.key, F.coalesce(key, F.lit(default))).drop(_FOUND, _PROBE, "_at", "_start")


def _on_timeline(probed: DataFrame, versions: DataFrame, policy: SkewPolicy) -> DataFrame:
    """Probed rows with the key and start of their version, if any, found per distinct (entity, time)."""
    found = versions_at(probed.select(F.col(_PROBE).alias("_entity"), "_at"), versions, policy)
    condition = (F.col(_PROBE) == F.col("_entity")) & (F.col("_at") == F.col("_when"))
    return probed.join(found, condition, "left").drop("_entity", "_when")


def _in_force(probed: DataFrame, versions: DataFrame) -> DataFrame:
    """Probed rows with the key and start of their version, if any, by an equi-join with the range as a residual."""
    later = F.lead("_from").over(Window.partitionBy("_entity").orderBy("_from", "_to", _FOUND))
    versions = versions.withColumn("_to", F.least("_to", later))
    condition = (F.col(_PROBE) == F.col("_entity")) & (F.col("_at") >= F.col("_from")) & (F.col("_at") < F.col("_to"))
    return probed.join(versions, condition, "left").drop("_entity", "_to").withColumnRenamed("_from", "_start")


def versions_at(probes: DataFrame, versions: DataFrame, policy: SkewPolicy) -> DataFrame:
    """For each distinct probe (_entity, _at) the key and start of the version in force, if any.

    Probes and version starts are laid on one timeline per entity, each probe takes
    the newest start before it, and a probe past that version's end finds none.
    """
    starts = versions.select(
        "_entity", F.col("_from").alias("_when"), F.lit(0).alias("_kind"), F.col("_to").alias("_end"), F.col(_FOUND).alias("_key"),
    )
    none = {name: F.lit(None).cast(starts.schema[name].dataType) for name in ("_end", "_key")}
    asks = (
        probes.where(F.col("_entity").isNotNull() & F.col("_at").isNotNull())
        .distinct()
        .select("_entity", F.col("_at").alias("_when"), F.lit(1).alias("_kind"))
        .withColumns(none)
    )
    marks = settle(starts.unionByName(asks), "marks")
    line = Timeline.over(marks, "_entity", ("_when", "_kind", "_end", "_key"), policy, marks.count())
    version = F.struct(F.col("_end").alias("end"), F.col("_key").alias("key"), F.col("_when").alias("start"))
    rows = line.carried(line.place(marks), F.when(F.col("_kind") == 0, version), "_last")
    hit = (F.col("_kind") == 1) & (F.col("_when") < F.col("_last.end"))
    found = (F.col("_last.key").alias(_FOUND), F.col("_last.start").alias("_start"))
    return line.done(rows).where(hit).select("_entity", "_when", *found)


_OWNER, _SLICE = "_owner", "_slice"


def with_slices(facts: DataFrame, owner: str, policy: SkewPolicy = SkewPolicy()) -> tuple[DataFrame, DataFrame | None]:
    """Facts with a slice number, 0 but for owners of more than ``rows_per_group`` facts, and those owners' slices.

    A hot owner's facts are dealt over as many slices as they need, by their position in the
    input, so ``facts`` must be read straight from a stored table. None stands for no hot owner.
    """
    if facts.count() <= policy.rows_per_group:
        return facts, None
    hot = hot_keys(facts, owner, policy.rows_per_group)
    if hot.isEmpty():
        return facts, None
    slices = hot.select(F.col("_hot").alias(_OWNER), F.ceil(F.col("n") / policy.rows_per_group).cast("long").alias("_slices"))
    # One row per owner of more than rows_per_group facts: at most rows / rows_per_group.
    dealt = facts.join(F.broadcast(slices), F.col(owner).eqNullSafe(F.col(_OWNER)), "left").drop(_OWNER)
    position = F.pmod(F.monotonically_increasing_id(), F.coalesce("_slices", F.lit(1)))
    return dealt.withColumn(_SLICE, position).drop("_slices"), slices


def _sliced(side: DataFrame, slices: DataFrame | None) -> DataFrame:
    """Rows of hot owners once for each of their slices, others in slice 0."""
    if slices is None:
        return side
    slices = slices.withColumnRenamed(_OWNER, "_hot_owner")
    met = side.join(F.broadcast(slices), F.col(_OWNER).eqNullSafe(F.col("_hot_owner")), "left")
    every = F.sequence(F.lit(0).cast("long"), F.coalesce("_slices", F.lit(1).cast("long")) - 1)
    return met.withColumn(_SLICE, F.explode(every)).drop("_hot_owner", "_slices")


def _by_owner(facts: DataFrame, side: DataFrame, owner: str, slices: DataFrame | None) -> DataFrame:
    """Left join on owner and slice; all such joins share one exchange and one sort of the facts."""
    if slices is None:
        return facts.join(side, F.col(owner) == F.col(_OWNER), "left").drop(_OWNER)
    side = side.withColumnRenamed(_SLICE, "_their_slice")
    met = (F.col(owner) == F.col(_OWNER)) & (F.col(_SLICE) == F.col("_their_slice"))
    return facts.join(side, met, "left").drop(_OWNER, "_their_slice")


@dataclass(frozen=True)
class History:
    """One point-in-time lookup of a fact: which versions, for which entity, at which time."""

    dim: DataFrame
    spec: Scd2Spec
    entity: Column
    at: Column
    largest: int | None = None  # most versions of one owner, where the table's pointer knows it


def owner_lookups(
    facts: DataFrame,
    owner: str,
    plain: dict[str, tuple[DataFrame, str, Any]],
    histories: list[History],
    slices: DataFrame | None = None,
    policy: SkewPolicy = SkewPolicy(),
    bare: bool = False,
) -> DataFrame:
    """All lookups whose keys begin with one and the same owner, in one shuffle of the facts.

    ``plain`` maps a new column to (dimension, its owner column, default): one row per owner. Each history is first
    gathered to one row per owner, the list of its entities' versions, so that every join has the
    owner alone as its key. A fact takes, among its entity's versions in the list that have begun, the one that
    began last, if it has not ended (as ``point_in_time_lookup``). Owners of more than ``versions_per_probe`` versions
    would make long lists; they alone are looked up by entity instead, and their lists are never made.
    With ``bare``, a key that is the hash of entity and start is left NULL beside its ``start_column``.
    """
    crowded = _crowded(histories, policy)
    if crowded is None:
        return _listed_lookups(facts, owner, plain, histories, slices, bare)
    mark = lambda df, key: df.join(crowded, F.col(key).eqNullSafe(F.col("_crowd")), "left")
    is_crowded = F.col("_crowd").isNotNull()
    facts = mark(facts, owner)
    rest = [replace(h, dim=mark(h.dim.withColumn(_OWNER, h.spec.owner()), _OWNER).where(~is_crowded).drop("_crowd", _OWNER)) for h in histories]
    done = _listed_lookups(facts.where(~is_crowded).drop("_crowd"), owner, plain, rest, slices, bare)
    others = _listed_lookups(facts.where(is_crowded).drop("_crowd"), owner, plain, [], slices)
    for h in histories:
        others = point_in_time_lookup(others, h.dim, h.spec, h.entity, h.at, policy=policy)
        if bare:
            others = others.withColumn(start_column(h.spec), F.lit(None).cast(STAMP))
    return done.unionByName(others.select(*done.columns))


def start_column(spec: Scd2Spec) -> str:
    """Where a bare lookup leaves the start of the version whose hashed key is to be made."""
    return f"_{spec.key}_start"


def _crowded(histories: list[History], policy: SkewPolicy) -> DataFrame | None:
    """Owners with more than ``versions_per_probe`` versions in any history, None if there are none."""
    found = []
    for h in histories:
        if h.largest is not None and h.largest <= policy.versions_per_probe:
            continue
        versions = h.dim.select(h.spec.owner().alias(_OWNER)).where(F.col(_OWNER).isNotNull())
        found.append(hot_keys(versions, _OWNER, policy.versions_per_probe).select(F.col("_hot").alias("_crowd")))
    if not found:
        return None
    owners = settle(reduce(DataFrame.unionByName, found).distinct(), "crowded")
    return None if owners.isEmpty() else owners


def _listed_lookups(
    facts: DataFrame, owner: str, plain: dict[str, tuple[DataFrame, str, Any]], histories: list[History], slices: DataFrame | None,
    bare: bool = False,
) -> DataFrame:
    for name, (dim, key, default) in plain.items():
        side = _sliced(dim.select(F.col(key).alias(_OWNER), F.col(name).alias(_FOUND)), slices)
        facts = _by_owner(facts, side, owner, slices).withColumn(name, F.coalesce(_FOUND, F.lit(default))).drop(_FOUND)
    keys = [_OWNER] if slices is None else [_OWNER, _SLICE]
    for h in histories:
        version = F.struct(F.col(FROM).alias("a"), F.col(TO).alias("b"), without_key(h.spec).alias("key"), F.col(h.spec.entity).alias("entity"))
        versions = h.dim.where(F.col(FROM) < F.col(TO)).select(h.spec.owner().alias(_OWNER), version.alias("_version"))
        lists = _sliced(versions.where(F.col(_OWNER).isNotNull()), slices).groupBy(*keys).agg(F.collect_list("_version").alias("_versions"))
        facts = _by_owner(facts.withColumns({_PROBE: h.entity, "_at": h.at}), lists, owner, slices)
        begun = F.filter("_versions", lambda v: (v["entity"] == F.col(_PROBE)) & (v["a"] <= F.col("_at")))
        facts = facts.withColumn(_FOUND, F.array_max(begun))
        in_force, stored = F.col("_at") < F.col(f"{_FOUND}.b"), F.col(f"{_FOUND}.key")
        if bare:
            hashed = in_force & stored.isNull()
            facts = facts.withColumns({
                start_column(h.spec): F.when(hashed, F.col(f"{_FOUND}.a")),
                h.spec.key: F.when(~F.coalesce(hashed, F.lit(False)), F.coalesce(F.when(in_force, stored), F.lit(UNKNOWN_KEY))),
            })
        else:
            found = with_key(h.spec, stored, F.col(f"{_FOUND}.entity"), F.col(f"{_FOUND}.a"))
            facts = facts.withColumn(h.spec.key, F.coalesce(F.when(in_force, found), F.lit(UNKNOWN_KEY)))
        facts = facts.drop(_FOUND, "_versions", _PROBE, "_at")
    return facts
