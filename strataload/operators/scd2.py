"""Type 2 history that stays right when changes arrive late or out of order.

The stored dimension has the columns key, valid_fromdate, valid_todate, entity,
tracked columns, loaddate. A version is in force over [valid_fromdate, valid_todate).

What a load does, and keeps on purpose:

* A staged row whose key is already stored is ignored, even if it carries another
  value (L5). Versions are never deleted or changed, only re-closed (L8, L10).
* A staged row is a change if it differs from the row before it in time, stored or
  staged. Rows that are no change are not stored, so a value that was re-stated
  and dropped cannot resurface when a backdated row lands before it (L25).
* Entities without a new version keep their rows exactly as they are (L9).
* Rows with a NULL entity are never compared with stored ones.
"""

from __future__ import annotations

from datetime import datetime
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataload.functions import version_key
from strataload.operators.skew import PIECE, SkewPolicy, profile
from strataload.operators.timeline import Timeline
from strataload.schemas import NO_PREDECESSOR, OPEN_END, STAMP, Scd2Spec, stamp
from strataload.sources.scratch import settle

FROM, TO = "valid_fromdate", "valid_todate"
_NEW, _BEFORE, _AFTER, _AFFECTED = "_new", "_before", "_after", "_affected"


def new_rows(dim: DataFrame, staged: DataFrame, key: str, many: bool = False) -> DataFrame:
    """Staged rows whose key the dimension does not hold (C7); with ``many`` its keys are shuffled, never broadcast.

    A file of keys says little about their size in memory: ascending ones are ten times as large there.
    """
    keys = dim.select(key)
    return staged.join(keys.hint("merge") if many else keys, key, "left_anti")


def affected_rows(dim: DataFrame, staged: DataFrame, entity: str) -> DataFrame:
    """Stored rows of the entities that occur in the batch."""
    return dim.join(staged.select(entity).distinct(), entity, "left_semi")


def open_end() -> Column:
    return F.lit(OPEN_END.isoformat(sep=" ")).cast(STAMP)


def is_change(tracked: tuple[str, ...], before: str = _BEFORE, null_mode: str = "reference") -> Column:
    """Whether a row differs from the row before it, ``before`` being that row as a struct.

    ``reference``: an SQL ``<>`` against the earlier value, or a placeholder where
    there is none. So a NULL is never a change, and a value after a NULL always is.
    ``null_safe``: NULL is a value like any other, and the first row is a change.
    """
    if null_mode == "reference":
        tests = [F.col(c) != F.coalesce(F.col(f"{before}.{c}"), F.lit(NO_PREDECESSOR)) for c in tracked]
        return F.coalesce(reduce(or_, tests), F.lit(False))
    if null_mode == "null_safe":
        tests = [~F.col(c).eqNullSafe(F.col(f"{before}.{c}")) for c in tracked]
        return F.col(before).isNull() | reduce(or_, tests)
    raise ValueError(f"null_mode is 'reference' or 'null_safe', not {null_mode!r}")


def _rows_in_time(
    stored: DataFrame, staged: DataFrame, spec: Scd2Spec, loaddate: datetime, known: bool = False, many: bool = False
) -> DataFrame:
    """Stored rows and the staged rows of keys not stored yet, in one layout, tracked columns as text (G1).

    With ``known``, staged rows of stored keys stay, to be dropped where they meet. With ``many``, the
    new rows are settled, since hot entities are counted, found and cut in passes of their own.
    """
    tracked = [F.col(c).cast("string").alias(c) for c in spec.tracked]
    old = stored.select(spec.key, spec.entity, FROM, TO, *tracked, "loaddate", F.lit(0).alias(_NEW))
    if not known:
        staged = new_rows(stored, staged, spec.key, many)
        staged = settle(staged, "new-rows") if many else staged
    new = staged.select(
        spec.key, spec.entity,
        F.col(spec.change).cast(STAMP).alias(FROM), F.lit(None).cast(STAMP).alias(TO),
        *tracked, stamp(loaddate).alias("loaddate"), F.lit(1).alias(_NEW),
    )
    return old.unionByName(new)


def without_key(spec: Scd2Spec, start: str = FROM) -> Column:
    """The key, NULL if it is the hash of the row's entity and start and so need not travel; ``with_key`` makes it again."""
    key = F.col(spec.key)
    return F.when(key != version_key(F.col(spec.entity), F.col(start)), key) if spec.hashed else key


def with_key(spec: Scd2Spec, key: Column, entity: Column, start: Column) -> Column:
    return F.coalesce(key, version_key(entity, start)) if spec.hashed else key


def _unknown_rows(rows: DataFrame, spec: Scd2Spec, line: Timeline) -> DataFrame:
    """Without the staged rows of stored keys: a stored version comes right before its staged twins."""
    own = F.struct(FROM, spec.key)
    before = line.window().rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_stored", F.last(F.when(F.col(_NEW) == 0, own), ignorenulls=True).over(before))
    return rows.where((F.col(_NEW) == 0) | ~F.col("_stored").eqNullSafe(own)).drop("_stored")


def _meeting(stored: DataFrame, staged: DataFrame, spec: Scd2Spec, loaddate: datetime, policy: SkewPolicy, at_most: int) -> tuple[DataFrame, Timeline]:
    """Stored and staged rows without the staged ones of stored keys, on their timeline.

    Rows of hashed keys are shuffled once, by entity and without the key. Other keys, and hot
    entities, take an anti join on the key first.
    """
    many = at_most > min(policy.rows_per_group, policy.broadcast_keys)
    if spec.hashed:
        bare = staged
        if spec.key not in staged.columns:  # left out where it is stored, and made only for hot entities
            bare = staged.withColumn(spec.key, F.lit(None).cast("string"))
            staged = staged.withColumn(spec.key, version_key(F.col(spec.entity), F.col(spec.change)))
        rows = _rows_in_time(stored, bare, spec, loaddate, known=True).withColumn(spec.key, without_key(spec))
        line = _timeline(rows, spec, policy, at_most)
        if line.cuts is None:
            rows = _unknown_rows(rows, spec, line)
            return rows, line
        return _rows_in_time(stored, staged, spec, loaddate, many=many), line
    rows = _rows_in_time(stored, staged, spec, loaddate, many=many)
    return rows, _timeline(rows, spec, policy, at_most)


def _made_key(spec: Scd2Spec) -> Column:
    return with_key(spec, F.col(spec.key), F.col(spec.entity), F.col(FROM))


def _timeline(rows: DataFrame, spec: Scd2Spec, policy: SkewPolicy, at_most: int) -> Timeline:
    return Timeline.over(rows, spec.entity, (FROM, spec.key, _NEW), policy, at_most)


def _with_changes(rows: DataFrame, spec: Scd2Spec, line: Timeline, null_mode: str) -> DataFrame:
    """Drop staged rows that change nothing.

    The comparison shares the partitioning and the order of the interval step: beside
    the exchange on the key that drops known rows, a load costs one shuffle and one sort.
    """
    is_new = F.col(_NEW) == 1
    rows = line.previous(rows, list(spec.tracked), _BEFORE)
    return rows.where(~is_new | is_change(spec.tracked, null_mode=null_mode)).drop(_BEFORE)


def detect_changes(
    dim: DataFrame,
    staged: DataFrame,
    spec: Scd2Spec,
    loaddate: datetime,
    null_mode: str = "reference",
    policy: SkewPolicy = SkewPolicy(),
) -> DataFrame:
    """The new versions a load would insert, still without an end."""
    arrived = staged.count()
    touched, _ = _touched(dim, staged, spec, arrived, policy)
    rows, line = _meeting(touched, staged, spec, loaddate, policy, dim.count() + arrived)
    kept = line.done(_with_changes(line.place(rows), spec, line, null_mode))
    return kept.where(F.col(_NEW) == 1).drop(_NEW, TO).withColumn(spec.key, _made_key(spec))


def _touched(dim: DataFrame, staged: DataFrame, spec: Scd2Spec, arrived: int, policy: SkewPolicy) -> tuple[DataFrame, DataFrame]:
    """Stored rows that a batch has to meet, and the others: by a broadcast list of few entities, else all but the NULL entity."""
    if arrived <= policy.broadcast_keys or profile(staged, spec.entity).keys <= policy.broadcast_keys:
        entities = F.broadcast(staged.select(spec.entity).distinct())
        return dim.join(entities, spec.entity, "left_semi"), dim.join(entities, spec.entity, "left_anti")
    return dim.where(F.col(spec.entity).isNotNull()), dim.where(F.col(spec.entity).isNull())


def close_intervals(
    dim: DataFrame, affected: DataFrame, spec: Scd2Spec, policy: SkewPolicy = SkewPolicy()
) -> DataFrame:
    """End every version of the affected entities where the next one starts."""
    entities = affected.select(spec.entity).distinct()
    touched = dim.join(entities, spec.entity, "left_semi")
    untouched = dim.join(entities, spec.entity, "left_anti")
    line = Timeline.over(touched, spec.entity, (FROM, spec.key), policy, dim.count())
    rows = line.following(line.place(touched), [FROM], _AFTER)
    closed = rows.withColumn(TO, F.coalesce(F.col(f"{_AFTER}.{FROM}"), open_end())).drop(_AFTER)
    return line.done(closed).select(*dim.columns).unionByName(untouched.select(*dim.columns))


def _scanned_in_pieces(rows: DataFrame, spec: Scd2Spec, line: Timeline, null_mode: str) -> DataFrame:
    """Kept rows with the start of the next kept row and whether their entity changes, for hot entities too.

    A segmented scan. Within a piece of a hot entity everything is known but for its first row,
    which needs the last row of the piece before. So each piece gives one edge row: its first and
    last row, and, of the others, the first start that is kept and whether a new one is. The scan over these few
    rows settles the first rows and what follows the last ones, and one join brings it back.
    """
    is_new = F.col(_NEW) == 1
    own = F.struct(*spec.tracked)
    rows = rows.withColumns({
        "_lag": F.lag(F.struct(own.alias("row"))).over(line.window()), "_tracked": own,
    }).withColumns({_BEFORE: F.col("_lag.row"), "_head": F.col("_lag").isNull()})
    # A first row is judged by the scan, or, where no piece comes before, right here.
    kept = ~is_new | is_change(spec.tracked, null_mode=null_mode)
    inner = ~F.col("_head") & kept
    edges = line.edges(
        rows, _last=line.last_of(F.struct(F.col("_tracked").alias("row"))),
        _first=line.first_of(F.struct(F.col("_tracked").alias("row"), F.col(_NEW).alias("new"), F.col(FROM).alias("start"))),
        _rest_start=F.min(F.when(inner, F.col(FROM))), _rest_new=F.max((inner & is_new).cast("int")),
    )
    along = line.along()
    edges = edges.withColumn(_BEFORE, F.lag("_last").over(along)["row"])
    # The first row's values beside those before it, under the names that the comparison uses.
    firsts = edges.withColumns({c: F.col(f"_first.row.{c}") for c in spec.tracked})
    first_kept = (F.col("_first.new") == 0) | is_change(spec.tracked, null_mode=null_mode)
    firsts = firsts.withColumn("_first_kept", first_kept).withColumns({
        "_start": F.coalesce(F.when(F.col("_first_kept"), F.col("_first.start")), F.col("_rest_start")),
        "_any": F.greatest(F.coalesce("_rest_new", F.lit(0)), (F.col("_first_kept") & (F.col("_first.new") == 1)).cast("int")),
    })
    onward = along.rowsBetween(1, Window.unboundedFollowing)
    found = firsts.select(
        line.entity, PIECE, "_first_kept",
        F.first("_start", ignorenulls=True).over(onward).alias("_next_start"),
        (F.max("_any").over(Window.partitionBy(line.entity)) == 1).alias("_any_new"),
    )
    rows = line.meet(rows, found)
    kept = F.when(F.col("_head") & F.col("_first_kept").isNotNull(), F.col("_first_kept")).otherwise(kept)
    rows = rows.where(kept)
    group = Window.partitionBy(line.entity, PIECE)
    rows = rows.withColumns({
        _AFTER: F.coalesce(F.lead(FROM).over(line.window()), F.col("_next_start")),
        _AFFECTED: F.coalesce("_any_new", F.max(F.col(_NEW)).over(group) == 1),
    })
    return rows.drop("_lag", "_tracked", "_head", "_first_kept", "_next_start", "_any_new", _BEFORE)


def load_scd2(
    dim: DataFrame,
    staged: DataFrame,
    spec: Scd2Spec,
    loaddate: datetime,
    null_mode: str = "reference",
    policy: SkewPolicy = SkewPolicy(),
) -> DataFrame:
    """The dimension after loading one batch.

    ``staged`` and ``dim`` are read more than once, so both should be stored
    tables. While the batch has few entities, counted first, their list is broadcast
    and the rest of the dimension passes through without a shuffle. A larger batch
    merges with the whole dimension in a single shuffle instead.
    """
    arrived = staged.count()
    touched, untouched = _touched(dim, staged, spec, arrived, policy)
    rows, line = _meeting(touched, staged, spec, loaddate, policy, dim.count() + arrived)
    if line.cuts is None:
        rows = _with_changes(rows, spec, line, null_mode)
        rows = line.following(rows, [FROM], _AFTER)
        rows = line.anywhere(rows, F.col(_NEW) == 1, _AFFECTED)
        rows = rows.withColumn(_AFTER, F.col(f"{_AFTER}.{FROM}"))
    else:
        rows = _scanned_in_pieces(line.place(rows), spec, line, null_mode)
    ended = F.coalesce(F.col(_AFTER), open_end())
    merged = line.done(rows).withColumns({
        TO: F.when(F.col(_AFFECTED), ended).otherwise(F.col(TO)), spec.key: _made_key(spec),
    })
    return merged.select(*dim.columns).unionByName(untouched.select(*dim.columns))
