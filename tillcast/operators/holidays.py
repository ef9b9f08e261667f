"""Holiday dimension (H1, H4-H7) and the holiday joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.config import ForecastConfig
from tillcast.functions.coerce import normalize_key, to_date_strict
from tillcast.functions.holiday import NO_HOLIDAY_TYPE, REGULAR_DAY, holiday_type, is_major_festival
from tillcast.operators.joins import checked_broadcast, left_join_null_safe
from tillcast.sources.readers import require_columns

HOLIDAY_COLUMNS = ("date", "state", "holiday_name")


def distinct_holidays(raw: DataFrame) -> DataFrame:
    """H1: validate, convert the date strictly (bad value fails the job), full-row distinct."""
    require_columns(raw, HOLIDAY_COLUMNS, "holiday_master")
    return raw.withColumn("date", to_date_strict(raw, "date")).dropDuplicates()


def holiday_dimension(raw: DataFrame, cfg: ForecastConfig) -> DataFrame:
    """H2-H5: typed, classified, de-duplicated holiday rows keyed by the join keys."""
    h = raw.withColumn("date", to_date_strict(raw, "date"))
    if cfg.normalize_state and "state" in h.columns:
        h = h.withColumn("state", normalize_key(F.col("state")))
    name = F.col("holiday_name")
    h = h.select(
        "date",
        *(["state"] if "state" in cfg.holiday_join_keys else []),
        "holiday_name",
        holiday_type(name).alias("holiday_type"),
        F.lit(1).alias("is_holiday"),
        is_major_festival(name).alias("is_major_festival"),
    )
    return one_per_day(h, list(cfg.holiday_join_keys)) if cfg.one_holiday_per_day else h.dropDuplicates()


#: Which holiday names a day with several of them, the first type that occurs; equal types by name.
TYPE_PRIORITY = ("NATIONAL", "FESTIVAL", "BANK", "STATE")


def one_per_day(dim: DataFrame, keys: list[str]) -> DataFrame:
    """One row for each key: name and type of the first holiday by type priority, flags of any of them.

    Names are compared as they are, a missing one comes last. The join then keeps one row for each row
    of the panel, so the row-based windows are not shifted.
    """
    place = F.coalesce(*[F.when(F.col("holiday_type") == t, F.lit(i)) for i, t in enumerate(TYPE_PRIORITY)])
    order = F.struct(place, F.col("holiday_name").isNull(), "holiday_name")
    first = F.min_by(F.struct("holiday_name", "holiday_type"), order).alias("first")
    out = dim.groupBy(*keys).agg(first, F.max("is_holiday").alias("is_holiday"), F.max("is_major_festival").alias("is_major_festival"))
    return out.select(*keys, "first.holiday_name", "first.holiday_type", "is_holiday", "is_major_festival")


def fill_non_holiday(df: DataFrame) -> DataFrame:
    """Rows without a holiday get 'Regular Day', type NONE and 0 flags."""
    fills = {
        "holiday_name": F.coalesce(F.col("holiday_name"), F.lit(REGULAR_DAY)),
        "is_holiday": F.coalesce(F.col("is_holiday"), F.lit(0)).cast("int"),
    }
    if "holiday_type" in df.columns:
        fills["holiday_type"] = F.coalesce(F.col("holiday_type"), F.lit(NO_HOLIDAY_TYPE))
    if "is_major_festival" in df.columns:
        fills["is_major_festival"] = F.coalesce(F.col("is_major_festival"), F.lit(0)).cast("int")
    return df.withColumns(fills)


def join_holidays(tx: DataFrame, dim: DataFrame, cfg: ForecastConfig, checked: bool = False) -> DataFrame:
    """J1 (date, state) or J2 (date only): left join, NULL keys match, fan-out kept.

    The dimension is broadcast behind a row-count check so the panel keeps its
    partitioning on atm_id and the windows after this join need no new exchange.
    ``checked=True`` means the caller already ran ``checked_broadcast`` on ``dim``.
    """
    if not checked:
        dim, _ = checked_broadcast(dim, cfg.broadcast_max_rows)
    return fill_non_holiday(left_join_null_safe(tx, dim, list(cfg.holiday_join_keys)))


def country_calendar(calendar: DataFrame, years: tuple[int, ...]) -> DataFrame:
    """H6 dimension: one row per date of the chosen years; several names on one date are
    joined with '; ' in name order so that the lookup is a function of the date."""
    c = calendar.withColumn("date", to_date_strict(calendar, "date"))
    c = c.where(F.year("date").isin(list(years)))
    return c.groupBy("date").agg(
        F.array_join(F.array_sort(F.collect_set("holiday_name")), "; ").alias("holiday_name"))


def calendar_dimension(calendar: DataFrame, cfg: ForecastConfig) -> DataFrame:
    return country_calendar(calendar, cfg.calendar_years).withColumn("is_holiday", F.lit(1))


def join_country_calendar(tx: DataFrame, calendar: DataFrame, cfg: ForecastConfig, dim: DataFrame | None = None
                          ) -> DataFrame:
    """H6: membership flag and name lookup with default 'Regular Day'.
    ``dim`` may be a prepared (already checked) ``calendar_dimension``."""
    if dim is None:
        dim, _ = checked_broadcast(calendar_dimension(calendar, cfg), cfg.broadcast_max_rows)
    return fill_non_holiday(left_join_null_safe(tx, dim, ["date"]))


def holiday_calendar(calendar: DataFrame, year: int) -> DataFrame:
    """H7: the calendar of one year, ordered by date."""
    return country_calendar(calendar, (year,)).orderBy("date")
