"""Pipeline parameters and the three presets (v1 default, v0, v2)."""

from __future__ import annotations

from dataclasses import dataclass, replace

# Horizon label -> (target column, rows ahead). Fixed values of the report.
HORIZONS: tuple[tuple[str, str, int], ...] = (
    ("Next_Day", "target_1day", 1),
    ("Next_3_Days", "target_3day", 3),
    ("Next_Week", "target_7day", 7),
)

# Names and order of the feature lists (D6), and the model's rounds, rate and
# patience in ForecastConfig below, must equal the reference's.
V1_FEATURES: tuple[str, ...] = (
    "atm_id", "state",
    "day_of_week", "day_of_month", "month", "is_friday", "is_weekend", "is_salary_period",
    "is_holiday", "holiday_name", "holiday_type", "is_major_festival",
    "is_pre_holiday", "is_long_weekend",
    "is_salary_friday", "is_salary_weekend", "is_salary_weekend_holiday", "is_salary_long_weekend",
    "dispense_lag_1", "dispense_lag_2", "dispense_lag_7", "dispense_roll_mean_7", "dispense_roll_mean_14",
)

V0_FEATURES: tuple[str, ...] = (
    "atm_id", "location_type", "city_tier", "uptime_pct", "downtime_pct",
    "day_of_week", "day_of_month", "month", "is_friday", "is_weekend", "is_salary_period",
    "is_holiday", "holiday_name",
    "is_pre_holiday", "is_long_weekend",
    "is_salary_friday", "is_salary_weekend", "is_salary_weekend_holiday", "is_salary_long_weekend",
    "dispense_lag_1", "dispense_lag_2", "dispense_lag_7", "dispense_roll_mean_7", "dispense_roll_mean_14",
)

V2_FEATURES: tuple[str, ...] = tuple(f for f in V1_FEATURES if f != "state")

CATEGORICAL = ("atm_id", "state", "location_type", "city_tier", "holiday_name", "holiday_type")


@dataclass(frozen=True)
class ForecastConfig:
    """All knobs of the pipeline. Field defaults are the v1 preset."""

    name: str = "v1"
    # ingest / cleaning
    date_formats: tuple[str, ...] = ("yyyy-MM-dd",)
    normalize_state: bool = True
    drop_inactive: bool = True
    # holidays: "table" joins a holiday master, "calendar" a country calendar (date -> name)
    holiday_source: str = "table"
    holiday_join_keys: tuple[str, ...] = ("date", "state")
    calendar_years: tuple[int, ...] = (2025, 2026)
    # False: several holidays on one day give several rows of a machine's day, as in the reference
    one_holiday_per_day: bool = False
    use_metadata: bool = False
    # windows
    roll_short: int = 7
    roll_long: int = 14
    roll_long_min_periods: int = 11
    lags: tuple[int, ...] = (1, 2, 7)
    required_columns: tuple[str, ...] = ("atm_id", "date", "dispense")
    # dataset
    val_days: int = 7
    horizons: tuple[tuple[str, str, int], ...] = HORIZONS
    features: tuple[str, ...] = V1_FEATURES
    # model
    max_iter: int = 400
    step_size: float = 0.03
    max_depth: int = 5
    max_bins: int = 256
    # inputs that the trees split as categories; other categoricals become target means
    nominal: tuple[str, ...] = ("state", "holiday_type", "location_type", "city_tier")
    min_instances_per_node: int = 20
    seed: int = 42
    patience: int = 30
    # early stopping runs only with more validation rows than this (v1: 100; v0/v2: any)
    early_stop_min_val_rows: int = 100
    skip_empty_horizon: bool = True
    clip_lower: bool = True
    encoding_smoothing: float = 20.0
    encoding_folds: int = 5  # of the training rows, for target means out of fold
    stage_trees: int = 25  # trees between two written stages of the boosting loop
    parallel_horizons: int = 3  # horizons fitted concurrently (1 = one after another)
    # report
    report_date_column: str = "reference_date"
    report_extra_columns: tuple[str, ...] = ()
    forecast_date_label: bool = True
    sheet_style: str = "date"  # "date": dd-Mon-YYYY[_Pn] (v1); "label": label[_Part_n] (v2); "plain": label (v0)
    max_rows_per_sheet: int = 1_000_000
    # scale
    skew_guard: bool = True
    broadcast_max_rows: int = 2_000_000
    hot_key_min_rows: int = 5_000_000
    chunk_rows: int = 1_000_000

    def with_(self, **kw) -> "ForecastConfig":
        return replace(self, **kw)


V1 = ForecastConfig()

V0 = ForecastConfig(
    name="v0",
    normalize_state=False,
    drop_inactive=False,
    holiday_source="calendar",
    holiday_join_keys=("date",),
    use_metadata=True,
    roll_long_min_periods=14,
    required_columns=("atm_id", "date", "dispense", "uptime_pct", "downtime_pct"),
    val_days=30,
    features=V0_FEATURES,
    early_stop_min_val_rows=0,
    skip_empty_horizon=False,
    clip_lower=False,
    report_date_column="last_historical_date",
    report_extra_columns=("location_type", "city_tier"),
    forecast_date_label=False,
    sheet_style="plain",
)

V2 = ForecastConfig(
    name="v2",
    normalize_state=False,
    holiday_join_keys=("date",),
    roll_long_min_periods=14,
    features=V2_FEATURES,
    early_stop_min_val_rows=0,
    skip_empty_horizon=False,
    clip_lower=False,
    forecast_date_label=False,
    sheet_style="label",
)

PRESETS = {"v0": V0, "v1": V1, "v2": V2}


def preset(name: str, **overrides) -> ForecastConfig:
    return PRESETS[name].with_(**overrides)
