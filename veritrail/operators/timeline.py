"""Snapshot calendars, and the expansion of dated facts to the snapshots that see them.

A calendar has a day in each step from its first, and the as-of date. The snapshots of a fact are computed from its
date: no list of all snapshots is scanned for each row, and only rows that match are made."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..contract import FIRST_SNAPSHOT


@dataclass(frozen=True)
class Calendar:
    as_of: date
    first: date = FIRST_SNAPSHOT
    step: int = 7

    @property
    def last_step(self) -> date | None:
        """The last regular snapshot."""
        if self.as_of < self.first:
            return None
        return self.first + timedelta(days=(self.as_of - self.first).days // self.step * self.step)

    def dates(self) -> list[date]:
        regular = [] if self.last_step is None else [self.first + timedelta(days=k) for k in range(0, (self.last_step - self.first).days + 1, self.step)]
        return regular if regular and regular[-1] == self.as_of else [*regular, self.as_of]

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([(d,) for d in self.dates()], "snapshot_date date")

    def _array(self, low: Column, high: Column) -> Column:
        """Snapshots from low to high, as an array; null where there is none."""
        off = F.lit(self.as_of)
        extra = F.array(off) if self.last_step != self.as_of else F.array().cast("array<date>")
        inside = (off >= low) & (off <= high)
        if self.last_step is None:
            return F.when(inside, extra)
        first = F.lit(self.first)
        start = F.date_add(first, (F.ceil(F.greatest(F.datediff(low, first), F.lit(0)) / self.step) * self.step).cast("int"))
        stop = F.least(high, F.lit(self.last_step))
        regular = F.when(start <= stop, F.sequence(start, stop, F.expr(f"interval {self.step} days"))).otherwise(F.array().cast("array<date>"))
        return F.concat(regular, F.when(inside, extra).otherwise(F.array().cast("array<date>")))

    def within(self, day: Column, days: int) -> Column:
        """The snapshots d with day in (d - days, d]; an empty array where day is null."""
        return F.when(day.isNotNull(), self._array(day, F.date_add(day, days - 1)))

    def first_on(self, day: Column) -> Column:
        """The first snapshot on or after day; null where there is none."""
        if self.last_step is None:
            return F.when(day <= F.lit(self.as_of), F.lit(self.as_of))
        first = F.lit(self.first)
        start = F.date_add(first, (F.ceil(F.greatest(F.datediff(day, first), F.lit(0)) / self.step) * self.step).cast("int"))
        return F.when(day <= F.lit(self.as_of), F.when(start <= F.lit(self.last_step), start).otherwise(F.lit(self.as_of)))

    def spanning(self, first: Column, last: Column) -> Column:
        """The snapshots from first to last."""
        return F.when(first.isNotNull() & last.isNotNull(), self._array(first, last))

    def since(self, day: Column) -> Column:
        """The snapshots on or after day."""
        return F.when(day.isNotNull(), self._array(day, F.lit(self.as_of)))


def expand_within(df: DataFrame, column: str, calendar: Calendar, days: int, name: str = "snapshot_date") -> DataFrame:
    return df.withColumn(name, F.explode(calendar.within(F.col(column), days)))


def expand_since(df: DataFrame, column: str, calendar: Calendar, name: str = "snapshot_date") -> DataFrame:
    return df.withColumn(name, F.explode(calendar.since(F.col(column))))


def swept_days(periods: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, since, until, weight): the runs of days between which the number of periods (keys, first, last) that hold changes."""
    turns = periods.select(*keys, F.inline(F.array(F.struct(F.col("first").alias("since"), F.lit(1).alias("turn")), F.struct(F.date_add("last", 1).alias("since"), F.lit(-1).alias("turn")))))
    daily = turns.groupBy(*keys, "since").agg(F.sum("turn").alias("turn"))
    order = Window.partitionBy(*keys).orderBy("since")  # a row a day of a key at most
    return daily.select(*keys, "since", F.date_sub(F.lead("since").over(order), 1).alias("until"), F.sum("turn").over(order).alias("weight")).where("until is not null")


def swept(periods: DataFrame, keys: Sequence[str], calendar: Calendar, least: int = 1) -> DataFrame:
    """(keys, snapshot_date, weight): how many of the periods (keys, first, last) hold each snapshot, where at least so many do.

    A period counts one from its first day on and one less after its last; a running sum over these days tells what holds until the next. So a
    row is made for each snapshot of the result, and none for each that a period sees."""
    runs = swept_days(periods, keys).where(F.col("weight") >= least)
    return runs.select(*keys, F.explode(calendar.spanning(F.col("since"), F.col("until"))).alias("snapshot_date"), "weight")


def touches(facts: DataFrame, keys: Sequence[str], day: str, days: int) -> DataFrame:
    """(keys, first, last): the periods in which some fact of a key was seen in the last so many days; they do not overlap."""
    daily = facts.select(*keys, F.col(day).alias("day")).distinct()
    order = Window.partitionBy(*keys).orderBy("day")  # a row a day of a key at most
    late = daily.withColumn("new", F.coalesce(F.datediff("day", F.lag("day").over(order)) > days, F.lit(True)))
    spell = late.withColumn("spell", F.sum(F.col("new").cast("int")).over(order))
    return spell.groupBy(*keys, "spell").agg(F.min("day").alias("first"), F.date_add(F.max("day"), days - 1).alias("last")).drop("spell")
