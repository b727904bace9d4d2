"""Totals kept from day to day: a campaign reads the lines of new days only.

A store is a folder of three tables, each of them additive counts by customer and further keys:

    days/date=yyyymmdd     a slice per day, made from that day's lines
    weeks/week=n           a slice per week, the sum of its days within the horizon
    windows/as_of=yyyymmdd a slice per campaign day, windows of equal length counted back from it

A step writes one day, the slices of the weeks that gain or lose a day, and one slice of windows: those of the campaign day
before, with the days that changed their window taken out of the old and added to the new. Each of these slices is replaced
as a whole and depends on no slice that the step replaces before it but the day's own, so that a step which failed is run
again. Distinct baskets are additive because a basket lies within one day. A day that is corrected later is put again; then
`refresh_weeks` and `rebuild_windows` bring the rest up to date from the days.

Defined results: a null in a key is a key; spend, units of null count as zero; a day without lines has no rows; keys whose
lines have all expired leave their weeks and windows.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillweave.functions.local import local_rows
from tillweave.operators import filters as fl
from tillweave.sources import sinks

#: The additive columns.
SUMS = {"spend": "decimal(22,2)", "units": "bigint", "n_lines": "bigint", "baskets": "bigint"}


@dataclass(frozen=True)
class Store:
    """Where a store is and how it counts: key columns (name to type, cust_id among them), days of history, window length, day one of week 1."""

    spark: SparkSession
    path: str
    keys: dict[str, str]
    horizon: int = 363
    length: int = 28
    week_one: int = 19950102

    def read(self, name: str, part: str) -> DataFrame:
        ddl = ", ".join(f"{c} {t}" for c, t in (self.keys | ({"win": "int"} if name == "windows" else {}) | SUMS | {part: "int"}).items())
        return self.spark.read.schema(ddl).parquet(f"{self.path}/{name}")

    def days(self) -> DataFrame:
        return self.read("days", "date")

    def weeks(self) -> DataFrame:
        return self.read("weeks", "week")

    def windows(self, as_of: int) -> DataFrame:
        return self.read("windows", "as_of").filter(F.col("as_of") == as_of).drop("as_of")

    def week_of(self, day: int) -> int:
        return int(_apart(self.week_one, day) / 7) + 1

    def window_of(self, day: int, as_of: int) -> int | None:
        """The window that a day belongs to on a campaign day; none outside the horizon."""
        age = _apart(day, as_of)
        return age // self.length if 0 <= age <= self.horizon else None


def _apart(first: int, last: int) -> int:
    at = lambda d: datetime.strptime(str(d), "%Y%m%d")
    return (at(last) - at(first)).days


def _summed(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(*(F.sum(c).cast(t).alias(c) for c, t in SUMS.items()))


def day_totals(lines: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Additive totals by key and date of lines (sales_amt, item_qty, basket_id, date)."""
    nothing = F.lit(0)
    sums = {
        "spend": F.sum(F.coalesce("sales_amt", nothing)), "units": F.sum(F.coalesce("item_qty", nothing)),
        "n_lines": F.count("*"), "baskets": F.countDistinct("basket_id"),
    }
    return lines.groupBy(*keys, "date").agg(*(c.cast(SUMS[n]).alias(n) for n, c in sums.items()))


def put_day(store: Store, lines: DataFrame, day: int) -> None:
    """Make the lines of a day all there is of it."""
    sinks.replace_slice(day_totals(lines.filter(F.col("date") == day), list(store.keys)), f"{store.path}/days", {"date": day})


def refresh_weeks(store: Store, weeks: Iterable[int], as_of: int, days: DataFrame | None = None) -> None:
    """Sum the given weeks anew from their days within the horizon of a campaign day. days: the store's, if read already."""
    days = days or store.days()
    for week in sorted(set(weeks)):
        first = max(fl.shifted(store.week_one, 7 * (week - 1)), fl.shifted(as_of, -store.horizon))
        last = min(fl.shifted(store.week_one, 7 * week - 1), as_of)
        sinks.replace_slice(_summed(days.filter(F.col("date").between(first, last)), list(store.keys)), f"{store.path}/weeks", {"week": week})


def rebuild_windows(store: Store, as_of: int) -> None:
    """The windows of a campaign day from the days alone."""
    days = store.days().filter(F.col("date").between(fl.shifted(as_of, -store.horizon), as_of)).withColumn("win", fl.time_window_index("date", as_of, store.length))
    sinks.replace_slice(_summed(days, [*store.keys, "win"]), f"{store.path}/windows", {"as_of": as_of})


def build(store: Store, lines: DataFrame, as_of: int) -> None:
    """Fill a new store with the history of a campaign day. Large slices are written by several tasks, small ones by one."""
    keys, first = list(store.keys), fl.shifted(as_of, -store.horizon)
    days = day_totals(lines.filter(F.col("date").between(first, as_of)), keys)
    days.hint("rebalance", "date").write.mode("overwrite").partitionBy("date").parquet(f"{store.path}/days")
    weekly = store.days().filter(F.col("date").between(first, as_of)).withColumn("week", fl.week_number("date", store.week_one))
    _summed(weekly, [*keys, "week"]).hint("rebalance", "week").write.mode("overwrite").partitionBy("week").parquet(f"{store.path}/weeks")
    rebuild_windows(store, as_of)


def moves(store: Store, before: int, as_of: int) -> list[tuple[int, int, int]]:
    """(date, window, +1 or -1) of each day that is in another window, or in none, than on the campaign day before."""
    out = []
    for back in range(_apart(fl.shifted(before, -store.horizon), as_of) + 1):
        day = fl.shifted(as_of, -back)
        old, new = store.window_of(day, before), store.window_of(day, as_of)
        if old != new:
            out += [(day, w, sign) for w, sign in ((old, -1), (new, 1)) if w is not None]
    return out


def move_windows(store: Store, before: int, as_of: int, days: DataFrame | None = None) -> None:
    """The windows of a campaign day from those of the one before; of the days, only those that moved are read."""
    moved = moves(store, before, as_of)
    if not moved:
        raise ValueError(f"no day has moved between {before} and {as_of}")
    dates = sorted({d for d, _, _ in moved})
    signs = local_rows(store.spark, moved, "date int, win int, sign int")
    changed = (days or store.days()).filter(F.col("date").isin(*dates)).join(F.broadcast(signs), "date")
    signed = changed.select(*store.keys, "win", *((F.col(c) * F.col("sign")).cast(t).alias(c) for c, t in SUMS.items()))
    left = _summed(store.windows(before).unionByName(signed), [*store.keys, "win"]).filter("n_lines > 0")
    sinks.replace_slice(left, f"{store.path}/windows", {"as_of": as_of})


def step(store: Store, lines: DataFrame, before: int, as_of: int) -> None:
    """From one campaign day to a later one; lines: those of the days between, the later one included."""
    gone = [fl.shifted(before, i - store.horizon) for i in range(_apart(before, as_of))]
    new = [fl.shifted(before, i + 1) for i in range(_apart(before, as_of))]
    for day in new:
        put_day(store, lines, day)
    days = store.days()
    refresh_weeks(store, map(store.week_of, [*gone, *new]), as_of, days)
    move_windows(store, before, as_of, days)
