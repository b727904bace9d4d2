"""Checks of an export of allocations, each a DataFrame; the summary is their union."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillweave.functions.local import local_rows
from tillweave.functions.numeric import cents
from tillweave.operators.ranks import percentiles, same


def scope_overview(export: DataFrame, *more: str) -> DataFrame:
    return export.groupBy("scope", *more).agg(F.countDistinct("cust_id").alias("customers"))


def stretch_columns(export: DataFrame) -> DataFrame:
    """Stretch of the spend, and of the offer's threshold, in percent of the spend."""
    over = lambda x: cents(F.try_divide(100.0 * (x - F.col("estimated_spend")), F.col("estimated_spend")))
    return export.withColumns({"stretch_perc": over(F.col("spend_plus_stretch")), "threshold_stretch_perc": over(F.col("threshold"))})


def large_stretch(export: DataFrame, percent: float, spend: float) -> DataFrame:
    """Rows stretched by more than percent from a spend above the bound."""
    return stretch_columns(export).filter((F.col("stretch_perc") > percent) & (F.col("estimated_spend") > spend))


def large_without_large(allocated: DataFrame, spend: str, bands: DataFrame, limit: float, n: int = 2) -> DataFrame:
    """Rows that spend more than limit, but whose offer is not among the n of the highest bands."""
    large = bands.orderBy(F.desc("hi"), F.desc("offer_id")).limit(n).select("offer_id")
    return allocated.filter(F.col(spend) > limit).join(large, "offer_id", "left_anti")


def offer_volumes(export: DataFrame) -> DataFrame:
    """Customers of every offer by test group, all of them, and the control group's percentage."""
    wide = export.groupBy("offer_id", "offer_desc", "scope").pivot("test_group", ["treatment", "control"]).agg(F.countDistinct("cust_id")).fillna(0)
    total = F.col("treatment") + F.col("control")
    return wide.withColumns({"total": total, "percentage_control": cents(F.try_divide(100.0 * F.col("control"), total))})


def cell_breakdown(export: DataFrame, bands: Sequence[str]) -> DataFrame:
    """Per cell: customers, customers by band, quartiles and mean of the spend, mean stretch in money and in percent."""
    export, exact = stretch_columns(export), lambda c: F.col(c).cast("decimal(14,2)")
    s = F.col("estimated_spend").cast("decimal(14,2)")
    mean = lambda x: F.sum(x).cast("double") / F.count(x)
    cell = export.groupBy("test_type", "test_group").agg(
        F.countDistinct("cust_id").alias("customers"), mean(s).alias("avg"), mean((F.col("spend_plus_stretch") - F.col("estimated_spend")).cast("decimal(14,2)")).alias("avg_stretch"),
        mean(exact("stretch_perc")).alias("avg_stretch_perc"), mean(exact("threshold_stretch_perc")).alias("avg_threshold_stretch_perc"),
        *(F.countDistinct(F.when(F.col("band") == b, F.col("cust_id"))).alias(f"band_{i}") for i, b in enumerate(bands)),
    )
    steps = percentiles(export.select("test_type", "test_group", s.alias("s")), ["test_type", "test_group"], "s", (0.25, 0.75))
    both = cell.alias("c").join(steps.alias("q"), same("c", "q", ["test_type", "test_group"]))
    p25, p75 = (F.col("q.steps")[i].cast("double").alias(name) for i, name in enumerate(("p25", "p75")))
    return both.select("c.test_type", "c.test_group", "c.customers", p25, "c.avg", p75, *(f"c.{c}" for c in cell.columns[4:]))


def counts_within(export: DataFrame, low: int, high: int) -> DataFrame:
    """Customers and scopes whose number of offers, distinct or plain, is outside the range."""
    n = export.groupBy("cust_id", "scope").agg(F.count("offer_id").alias("n"), F.countDistinct("offer_id").alias("n_distinct"))
    return n.filter(~F.col("n").between(low, high) | ~F.col("n_distinct").between(low, high))


def repeated(export: DataFrame, keys: Sequence[str]) -> DataFrame:
    return export.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def both_groups(export: DataFrame) -> DataFrame:
    return export.groupBy("cust_id").agg(F.countDistinct("test_group").alias("groups")).filter("groups > 1")


def not_in(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    return left.select(key).distinct().join(right.select(key).distinct(), key, "left_anti")


def summary(checks: dict[str, DataFrame]) -> DataFrame:
    """check, failures, status: Passed where a check found nothing."""
    out = None
    for name, bad in checks.items():
        row = bad.agg(F.count("*").alias("failures")).select(F.lit(name).alias("check"), "failures", F.when(F.col("failures") == 0, "Passed").otherwise("Failed").alias("status"))
        out = row if out is None else out.unionByName(row)
    return out


def assignment_checks(people: DataFrame, cells: DataFrame, quotas: Sequence[tuple[str, str, int]], ratio: float = 0.5, key: str = "cust_id") -> DataFrame:
    """Nobody twice, unknown or left out; cells as large as their quotas, types alike to 2 customers, the
    treatment ratio right to 0.05 and one customer a type (quotas are whole numbers)."""
    asked = local_rows(people.sparkSession, [tuple(q) for q in quotas], "test_type string, test_group string, n long")
    sizes = cells.groupBy("test_type", "test_group").agg(F.count("*").alias("have"))
    wrong = asked.filter("n > 0").join(sizes, ["test_type", "test_group"], "left").filter("not n <=> have")
    spread = cells.groupBy("test_type").count().agg((F.max("count") - F.min("count")).alias("spread")).filter("spread > 2")
    types = len({t for t, _, _ in quotas})
    treated = cells.agg(F.count_if(F.col("test_group") == "treatment").alias("treated"), F.count("*").alias("n"))
    treated = treated.filter(F.abs(F.col("treated") - ratio * F.col("n")) > 0.05 * F.col("n") + types)
    return summary({"assigned once": repeated(cells, [key]), "known": not_in(cells, people, key), "covered": not_in(people, cells, key), "sizes": wrong, "uniform": spread, "ratio": treated})


def allocation_matrix(export: DataFrame, rewards: Sequence[float]) -> DataFrame:
    """Percent of a cell's customers by threshold and reward."""
    total = export.groupBy("test_type").agg(F.count("*").alias("__n"))
    wide = export.groupBy("test_type", "threshold").agg(*(F.count_if(F.col("reward") == r).alias(f"reward_{int(r)}") for r in rewards))
    both = wide.join(F.broadcast(total), "test_type")
    return both.select("test_type", "threshold", *(cents(100.0 * F.col(f"reward_{int(r)}") / F.col("__n")).alias(f"reward_{int(r)}") for r in rewards))
