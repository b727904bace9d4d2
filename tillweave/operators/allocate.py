"""From predictions and stretches to offers. Loops over baselines, rewards and categories are join keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillweave.functions.hashing import uniform
from tillweave.functions.numeric import cents, percent_change
from tillweave.operators.joins import elementary_bands, offer_at


def fixed_stretch(df: DataFrame, percents: Sequence[int], stretches: Sequence[int], keys: Sequence[str] = ("cust_id",)) -> DataFrame:
    cols = [(F.col(f"{p}th_percentile") * (1 + s / 100)).alias(f"{p}_stretch_{s}_perc") for p in percents for s in stretches]
    return df.select(*keys, *(f"{p}th_percentile" for p in percents), *cols)


def under_prediction_floor(df: DataFrame, factor: float = 1.2) -> DataFrame:
    """Predictions below what is spent become the spend times factor; the original stays beside."""
    low = F.col("prediction") < F.col("actual")
    return df.withColumns({"prediction_original": F.col("prediction"), "prediction": F.when(low, F.col("actual") * factor).otherwise(F.col("prediction"))})


def scores(df: DataFrame, low: float = -0.5, high: float = 200.0) -> DataFrame:
    """pct_error of the prediction and outlier (0 within the limits)."""
    out = df.withColumn("pct_error", percent_change(F.col("prediction"), F.col("actual")))
    return out.withColumn("outlier", F.when(F.col("pct_error").between(low, high), 0).otherwise(1))


def used_headroom(df: DataFrame, most: float = 80.0, least: float = 5.0, factor: float = 1.2, not_bought: float = 0.0) -> DataFrame:
    """spend_plus_stretch: the actual spend stretched by the held error, or a share of the prediction if nothing was bought."""
    e = F.col("pct_error")
    frac = F.when(F.col("outlier") == 1, factor).when(e >= most, 1 + most / 100).when(e <= least, 1 + least / 100).otherwise(1 + e / 100)
    total = F.when(F.col("actual") > 0, F.col("actual") * frac).otherwise(F.col("prediction") * not_bought)
    return df.withColumns({"fraction": frac, "spend_plus_stretch": cents(total).cast("decimal(14,2)")})


def basket_rollup(df: DataFrame, keys: Sequence[str] = ("cust_id",)) -> DataFrame:
    return df.groupBy(*keys).agg(F.sum("spend_plus_stretch").cast("double").alias("spend_plus_stretch"), F.sum(cents(F.col("actual")).cast("decimal(14,2)")).cast("double").alias("estimated_spend"))


def offer_mapping(variants: DataFrame, department: str, target: str | None, reward: int) -> DataFrame:
    """The configured bands of one department, target (None: every target) and reward; none at all are an error."""
    found = variants.filter((F.col("l1_id") == department) & (F.col("reward_perc") == reward))
    if target is not None:
        found = found.filter(F.col("target") == target)
    if found.isEmpty():
        raise ValueError(f"no offers of {department}, {target}, {reward} percent")
    return found


def edge_offers(bands: DataFrame, n: int, by: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Per key the n offers of the highest and of the lowest bands, as arrays."""
    top = bands.groupBy(*by).agg(F.slice(F.sort_array(F.collect_list(F.struct("hi", "offer_id")), False), 1, n).alias("t"), F.max("hi").alias("max_limit"))
    low = bands.groupBy(*by).agg(F.slice(F.sort_array(F.collect_list(F.struct("lo", "offer_id"))), 1, n).alias("t"))
    ids = F.transform("t", lambda x: x["offer_id"])
    return top.select(*by, ids.alias("large"), "max_limit"), low.select(*by, ids.alias("small"))


def allocate(df: DataFrame, spend: str, bands: DataFrame, by: Sequence[str] = (), user: str = "cust_id", n_fill: int = 2, seed: int = 7) -> DataFrame:
    """offer_id and offer_desc of every row: its band's offer; above all bands a keyed-random large one; without spend a small one.

    bands (configured, some per key of `by`) meet the rows by key, as sorted steps that are searched; of overlapping
    bands the last defined (largest ord) holds."""
    k = [*by] or ["__one"]
    if not by:
        df, bands = df.withColumn("__one", F.lit(1)), bands.withColumn("__one", F.lit(1))
    large, small = edge_offers(bands, n_fill, k)
    ladder = F.broadcast(elementary_bands(bands, k).join(large, k).join(small, k).withColumnRenamed("steps", "__ladder"))
    inside = offer_at(F.col("__ladder"), F.col(spend).cast("double"))
    u = uniform(seed, user)
    pick = lambda a: F.get(a, F.floor(u * F.size(a)).cast("int"))
    offer = F.when(F.col(spend) >= F.col("max_limit"), pick(F.col("large"))).when(inside.isNull(), pick(F.col("small"))).otherwise(inside)
    out = df.join(ladder, k, "left").withColumn("offer_id", offer).drop("__ladder", "large", "small", "max_limit", "__one")
    return out.join(F.broadcast(bands.select(*by, "offer_id", "offer_desc").distinct()), [*by, "offer_id"], "left")


def all_baselines(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key and stretch column: test_type and baseline_plus_stretch."""
    cols = [c for c in df.columns if "_stretch_" in c and c.endswith("_perc")]
    return df.select(*keys, *cols).unpivot(list(keys), cols, "test_type", "baseline_plus_stretch")


def round_estimates(df: DataFrame) -> DataFrame:
    """Totals and spends in cents; the stretch is the rounded total less the unrounded spend, rounded."""
    total = cents(F.col("spend_plus_stretch"))
    return df.withColumns({"spend_plus_stretch": total, "estimated_stretch": cents(total - F.col("estimated_spend")), "estimated_spend": cents(F.col("estimated_spend"))})


def within_upper_limit(df: DataFrame, spend: str, limits: DataFrame, key: str | None) -> DataFrame:
    """Category mode (key): spend below the target's largest limit; basket mode: up to the largest limit."""
    if key:
        return df.join(F.broadcast(limits), key).filter(F.col(spend) < F.col("max_limit")).drop("max_limit")
    top = limits.agg(F.max("max_limit").alias("max_limit"))
    return df.crossJoin(F.broadcast(top)).filter(F.col(spend) <= F.col("max_limit")).drop("max_limit")


def merge_caps(offers: DataFrame, given: DataFrame, generated: DataFrame, control: float = 0.0, impute: float | None = None, lower: float | None = None, upper: float | None = None, least: float = 0) -> DataFrame:
    """Caps of each offer: given ones first, else generated (imputed, held within overrides, plus control)."""
    both = offers.join(given, "offer_id", "left").join(generated, "offer_id", "left")
    made = F.coalesce("cap_generated", F.lit(impute).cast("double"))
    if lower is not None:
        made = F.greatest(made, F.lit(float(lower)))
    if upper is not None:
        made = F.when(made.isNotNull(), F.least(made, F.lit(float(upper))))
    most = F.ceil(F.coalesce(F.col("input_max_cap").cast("double"), made * (1 + control)))
    few = F.least(F.floor(F.coalesce(F.col("input_min_cap").cast("double"), F.lit(float(least)))), most)
    return both.select("offer_id", most.alias("max_cap"), few.alias("min_cap"), "input_markdown_cap")


def swap_offers(df: DataFrame, old: int, new: int, fraction: float, key: str = "cust_id", seed: int = 7, known: DataFrame | None = None) -> DataFrame:
    """A keyed-random fraction of one offer becomes another; only the offer column changes. With known offers, one that is not among them is an error."""
    if known is not None and known.filter(F.col("offer_id") == new).isEmpty():
        raise ValueError(f"offer {new} does not exist")
    hit = (F.col("offer_id") == old) & (uniform(seed, key) < fraction)
    return df.withColumn("offer_id", F.when(hit, F.lit(new).cast("long")).otherwise(F.col("offer_id")))


def with_ids(export: DataFrame, links: DataFrame, key: str = "cust_id", ids: Sequence[str] = ("account_id", "uk_digital_id")) -> DataFrame:
    """Rows of customers with an account, and its ids; a linked account without one of the ids fails the job."""
    sure = {c: F.when(F.col(c).isNull(), F.raise_error(F.lit(f"{c} is null"))).otherwise(F.col(c)) for c in ids}
    return export.join(links.filter(F.col(ids[0]).isNotNull()).withColumns(sure), key)


def limits_of(bands: DataFrame, by: Sequence[str] = ("target",)) -> DataFrame:
    return bands.groupBy(*by).agg(F.max("hi").alias("max_limit"))


def offers_remaining(counts: DataFrame, volumes: DataFrame, unit: str) -> DataFrame:
    """Offers still to be given out in units below their minimum volume.

    counts has a row per unit and variant with count, all_variant_count and no_of_variants; volumes has min_volume per unit.
    """
    short = counts.join(volumes, unit).filter("all_variant_count < min_volume")
    expected = F.col("min_volume").cast("double") / F.col("no_of_variants")
    return short.withColumn("expected_offer_count", expected).withColumn("remaining_offers", F.col("expected_offer_count") - F.col("count"))
