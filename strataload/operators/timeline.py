"""Looking at the row before or after, per entity and in time order.

This is ordinary window work while every entity fits a task. An entity that does
not is cut into pieces along its time axis; each piece is a window group of its
own, and only one edge row per piece travels to its neighbour. The result is the
same rows either way.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from strataload.operators.skew import PIECE, Cuts, SkewPolicy, find_cuts, profile, with_piece
from strataload.sources.scratch import settle

_EDGE, _OF, _AT = "_edge", "_edge_of", "_edge_at"


@dataclass(frozen=True)
class Timeline:
    entity: str
    order: tuple[str, ...]
    cuts: Cuts | None = None

    @classmethod
    def over(
        cls,
        rows: DataFrame,
        entity: str,
        order: tuple[str, ...],
        policy: SkewPolicy = SkewPolicy(),
        at_most: int | None = None,
    ) -> Timeline:
        """Measure ``rows`` (only the entity column is read) and cut hot entities, if any.

        ``at_most`` is a known bound on the number of rows; below the size of one
        group nothing can be hot and nothing is measured.
        """
        if at_most is not None and at_most <= policy.rows_per_group:
            return cls(entity, order)
        found = profile(rows, entity)
        return cls(entity, order, find_cuts(rows, entity, found, policy))

    def place(self, df: DataFrame) -> DataFrame:
        """Prepare a frame for the methods below.

        With hot entities the placed rows are settled, since the edge rows and the
        rows themselves must come from one and the same input.
        """
        if self.cuts is None:
            return df
        return settle(with_piece(df, self.entity, self.order, self.cuts), "timeline")

    def done(self, df: DataFrame) -> DataFrame:
        return df.drop(PIECE)

    @property
    def _group(self) -> list[str]:
        return [self.entity] if self.cuts is None else [self.entity, PIECE]

    def window(self) -> WindowSpec:
        return Window.partitionBy(*self._group).orderBy(*[F.col(c).asc_nulls_last() for c in self.order])

    def _rank(self) -> Column:
        """Order of a row as one comparable value, NULLs last."""
        parts = []
        for i, name in enumerate(self.order):
            parts += [F.col(name).isNull().alias(f"n{i}"), F.col(name).alias(f"v{i}")]
        return F.struct(*parts)

    def _across(self, df: DataFrame, edge: Column, out: str, forward: bool) -> DataFrame:
        """Fill ``out`` where it is NULL with the nearest piece's edge, for hot entities."""
        by_piece = Window.partitionBy(self.entity).orderBy(PIECE)
        if forward:
            reach, pick = by_piece.rowsBetween(Window.unboundedPreceding, -1), F.last
        else:
            reach, pick = by_piece.rowsBetween(1, Window.unboundedFollowing), F.first
        edges = (
            df.where(F.col(PIECE).isNotNull())
            .groupBy(self.entity, PIECE).agg(edge.alias(_EDGE))
            .select(self.entity, PIECE, pick(_EDGE, ignorenulls=True).over(reach).alias(_EDGE))
        )
        return self.meet(df, edges).withColumn(out, F.coalesce(out, _EDGE)).drop(_EDGE)

    def edges(self, df: DataFrame, **values: Column) -> DataFrame:
        """Of each piece of a hot entity the given aggregates, in one pass; one row per piece."""
        return df.where(F.col(PIECE).isNotNull()).groupBy(self.entity, PIECE).agg(*[v.alias(n) for n, v in values.items()])

    def along(self) -> WindowSpec:
        """The pieces of an entity in time order, for a scan over its edge rows."""
        return Window.partitionBy(self.entity).orderBy(PIECE)

    def first_of(self, value: Column) -> Column:
        """Aggregate: the value in the earliest row."""
        return F.min_by(value, self._rank())

    def last_of(self, value: Column) -> Column:
        """Aggregate: the value in the latest row."""
        return F.max_by(value, self._rank())

    def meet(self, df: DataFrame, edges: DataFrame) -> DataFrame:
        """Rows with what a scan over the edge rows found for their piece; NULL for other entities."""
        edges = edges.withColumnsRenamed({self.entity: _OF, PIECE: _AT})
        met = F.col(self.entity).eqNullSafe(F.col(_OF)) & (F.col(PIECE) == F.col(_AT))
        # One row per piece; adaptive execution broadcasts them if they are small.
        return df.join(edges, met, "left").drop(_OF, _AT)

    def previous(self, df: DataFrame, columns: list[str], out: str) -> DataFrame:
        """``out``: struct of ``columns`` of the row before, NULL if there is none."""
        row = F.struct(*columns)
        df = df.withColumn(out, F.lag(row).over(self.window()))
        if self.cuts is None:
            return df
        return self._across(df, F.max_by(row, self._rank()), out, forward=True)

    def following(self, df: DataFrame, columns: list[str], out: str) -> DataFrame:
        """``out``: struct of ``columns`` of the row after, NULL if there is none."""
        row = F.struct(*columns)
        df = df.withColumn(out, F.lead(row).over(self.window()))
        if self.cuts is None:
            return df
        return self._across(df, F.min_by(row, self._rank()), out, forward=False)

    def carried(self, df: DataFrame, value: Column, out: str) -> DataFrame:
        """``out``: the newest non-NULL ``value`` up to and including this row."""
        so_far = self.window().rowsBetween(Window.unboundedPreceding, Window.currentRow)
        df = df.withColumn(out, F.last(value, ignorenulls=True).over(so_far))
        if self.cuts is None:
            return df
        newest = F.max_by(value, F.when(value.isNotNull(), self._rank()))
        return self._across(df, newest, out, forward=True)

    def anywhere(self, df: DataFrame, condition: Column, out: str) -> DataFrame:
        """``out``: whether ``condition`` holds for any row of the entity."""
        flag = F.max(condition.cast("int"))
        df = df.withColumn(out, flag.over(Window.partitionBy(*self._group)) == 1)
        if self.cuts is None:
            return df
        hot = (
            df.where(F.col(PIECE).isNotNull())
            .groupBy(F.col(self.entity).alias(_OF)).agg((flag == 1).alias(_EDGE))
        )
        joined = df.join(hot, F.col(self.entity).eqNullSafe(F.col(_OF)), "left")
        return joined.withColumn(out, F.coalesce(_EDGE, out)).drop(_EDGE, _OF)
