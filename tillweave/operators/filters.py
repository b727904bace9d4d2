"""Row filters and derived columns over transaction lines and customers (all pushable or codegen)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values that results depend on: departments, groups and areas that are never counted.
SKIPPED_L2 = ("FOPA",)
SKIPPED_L4 = ("F98A", "F88A", "T46", "T63")
SKIPPED_L3 = ("40", "41")
SKIPPED_AREA = "PETROL STATIONS"
# Lower bounds of the age bands, the last one open.
AGE_BANDS = ((18, 25), (26, 30), (31, 35), (36, 40), (41, 45), (46, 50), (51, 55), (56, 60), (61, 65), (66, 70), (71, 75))


def int_date(year: str = "year", month: str = "month", day: str = "day") -> Column:
    """yyyymmdd as an integer."""
    return (F.col(year) * 10000 + F.col(month) * 100 + F.col(day)).cast("int")


def as_date(column: str | Column) -> Column:
    c = F.col(column) if isinstance(column, str) else column
    return F.to_date(c.cast("string"), "yyyyMMdd")


def shifted(date: int, days: int) -> int:
    return int((datetime.strptime(str(date), "%Y%m%d") + timedelta(days=days)).strftime("%Y%m%d"))


def days_between(column: str, first: int, last: int) -> Column:
    """A timestamp column within days first to last (yyyymmdd, both included), in a form that reaches the scan."""
    at = lambda d: f"timestamp_ntz'{datetime.strptime(str(d), '%Y%m%d'):%Y-%m-%d} 00:00:00'"
    return F.expr(f"{column} >= {at(first)} and {column} < {at(shifted(last, 1))}")


def common_filters() -> Column:
    """Counted lines. A null in any tested column drops the row (three-valued logic)."""
    return (
        ~F.col("l2_id").isin(*SKIPPED_L2)
        & (F.col("trans_line_type") == "S")
        & ~F.col("l4_id").isin(*SKIPPED_L4)
        & (F.col("area_name") != SKIPPED_AREA)
        & (F.col("sales_amt") >= 0.1)
        & ~F.col("l3_id").isin(*SKIPPED_L3)
        & F.col("cust_id").isNotNull()
    )


def lookback_filter(etl_date: int, days: int) -> Column:
    """Dates of the `days` before etl_date, both ends included."""
    return F.col("date").between(shifted(etl_date, -days), etl_date)


def channel_filter(l1_id: str, channels: Sequence[str] = ("POS",)) -> Column:
    """Store purchases; general merchandise counts online ones too."""
    return F.col("purchase_channel").isin("POS", "ONLINE") if l1_id == "GM" else F.col("purchase_channel").isin(*channels)


def outside_season(start: str = "1218", end: str = "0101") -> Column:
    """True outside a yearly MMDD range; a range with start after end wraps over new year."""
    day, a, b = F.col("date") % 10000, int(start), int(end)
    inside = (day >= a) & (day <= b) if a <= b else (day >= a) | (day <= b)
    return ~inside


def exclude_items(df: DataFrame, items: Mapping[str, Sequence[str]] | None) -> DataFrame:
    """Drop lines whose id at any listed level is listed there."""
    for level, ids in (items or {}).items():
        df = df.filter(~F.col(level).isin(*ids))
    return df


def registered_before(accounts: DataFrame, campaign: int, days: int) -> DataFrame:
    return accounts.filter(F.col("registration_date") <= F.lit(datetime.strptime(str(shifted(campaign, -days)), "%Y%m%d")))


def week_number(column: str, start: int) -> Column:
    """1 for the week that begins at start; truncated toward zero before it."""
    return (F.datediff(as_date(column), as_date(F.lit(start))) / 7).cast("int") + 1


def time_window_index(column: str, etl_date: int, length: int) -> Column:
    """0 for the most recent window of `length` days."""
    return F.floor(F.datediff(as_date(F.lit(etl_date)), as_date(column)) / length).cast("int")


def clean_demographics(df: DataFrame) -> DataFrame:
    """age within 18 to 120, affluence as a number (else 5), age_to_use from age, experian_age, or 56."""
    age = F.when(F.col("age").between(18, 120), F.col("age"))
    return df.withColumns(
        {
            "age": age,
            "experian_affluence": F.coalesce(F.expr("try_cast(experian_affluence as int)"), F.lit(5)),
            "age_to_use": F.coalesce(age, F.expr("try_cast(substring(experian_age, 1, 2) as int)"), F.lit(56)),
        }
    )


def age_band(age: str) -> Column:
    out = F.when(F.col(age).between(*AGE_BANDS[0]), "18-25")
    for lo, hi in AGE_BANDS[1:]:
        out = out.when(F.col(age).between(lo, hi), f"{lo}-{hi}")
    return out.when(F.col(age) >= 76, "76+")


def one_hot_demographics(df: DataFrame) -> DataFrame:
    """Gender, household and mosaic flags of raw codes, and prefixed categories with U for unknown."""
    flags = {f"gender_{g}": (F.col("gender").eqNullSafe(g)).cast("int") for g in ("F", "M")}
    flags |= {f"hh_comp_{i:02d}": F.col("experian_hh_composition").eqNullSafe(f"{i:02d}").cast("int") for i in range(12)}
    flags |= {f"mosaic_{i:02d}": F.col("experian_mosaic_uk_type").eqNullSafe(f"{i:02d}").cast("int") for i in range(67)}
    for c in ("experian_hh_composition", "experian_mosaic_uk_type"):
        flags[c] = F.concat(F.lit("Cat_"), F.coalesce(F.col(c), F.lit("U")))
    return df.withColumns(flags)


def tag_run(df: DataFrame, **constants) -> DataFrame:
    return df.withColumns({k: F.lit(v) for k, v in constants.items()})


def normalise_headers(df: DataFrame, aliases: Mapping[str, str]) -> DataFrame:
    """Lower-case names with underscores, then known aliases."""
    plain = [c.strip().lower().replace(" ", "_") for c in df.columns]
    return df.toDF(*(aliases.get(c, c) for c in plain))


def map_codes(column: str, codes: Mapping[str, str]) -> Column:
    """A code without white space, replaced where the map has it."""
    bare = F.regexp_replace(column, r"\s", "")
    table = F.create_map(*[F.lit(x) for kv in codes.items() for x in kv])
    return F.coalesce(F.try_element_at(table, bare), bare)


def offer_category_key(bu: str, desc: str) -> Column:
    """The text that identifies an offer's category: unit and description without digits and marks."""
    return F.concat(F.col(bu), F.regexp_replace(F.regexp_replace(F.lower(desc), r"[0-9]", ""), r"[^a-z_ ]", ""))


def parse_int_list(column: str) -> Column:
    """'[a,b]' as an array of integers."""
    return F.split(F.regexp_replace(column, r"[\[\]\s]", ""), ",").cast("array<int>")


def pounds(column: str, nth: int) -> Column:
    """The nth amount in pounds of a text, null where there are fewer."""
    return F.expr(f"try_cast(nullif(regexp_extract({column}, '{'.*?'.join(['£([0-9]+)'] * nth)}', {nth}), '') as double)")


def clean_scope(column: str) -> Column:
    """Text before the last underscore, the whole text where there is none."""
    c = F.col(column)
    cut = F.length(c) - F.instr(F.reverse(c), "_")
    return F.when(F.instr(c, "_") > 0, F.substring(c, F.lit(1), cut)).otherwise(c)


def null_counts(df: DataFrame) -> DataFrame:
    """column_name, n_null of the columns with nulls or NaN, from one pass."""
    kinds = dict(df.dtypes)
    bad = lambda c: F.col(c).isNull() | F.isnan(c) if kinds[c] in ("double", "float") else F.col(c).isNull()
    row = df.agg(*(F.count_if(bad(c)).alias(c) for c in df.columns))
    return row.unpivot([], list(df.columns), "column_name", "n_null").filter("n_null > 0")


def gender_target(units: str, men: Sequence[str], women: Sequence[str]) -> Column:
    """Men, Women or Both, by which units a list holds; null if neither."""
    has = lambda ids: F.arrays_overlap(F.col(units), F.array(*map(F.lit, ids)))
    return F.when(has(men) & has(women), "Both").when(has(men), "Men").when(has(women), "Women")
