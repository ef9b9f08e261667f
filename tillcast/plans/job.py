"""End-to-end job: read inputs, build features, train per horizon, write the report.

    python -m tillcast.plans.job --transactions PATH... --holidays PATH --out PATH [--preset v1]
        [--calendar PATH] [--metadata PATH] [--format parquet|csv] [--input-format parquet|csv] [--date-formats F...] [--max-iter N]
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillcast.config import ForecastConfig, preset
from tillcast.functions.coerce import to_date_lenient, to_number
from tillcast.operators.joins import release
from tillcast.operators.report import report_long, sheet_names
from tillcast.plans.features import feature_dataset
from tillcast.plans.forecast import ForecastRun, train_and_forecast
from tillcast.session import build_session
from tillcast.sources.readers import TRANSACTION_COLUMNS, read_parts, read_table, require_columns
from tillcast.sources.sinks import write_report


def forecast_report(tx: DataFrame, cfg: ForecastConfig, holidays: DataFrame | None = None,
                    calendar: DataFrame | None = None, metadata: DataFrame | None = None
                    ) -> tuple[DataFrame, ForecastRun]:
    """Features -> models -> long report with sheet names (not yet written)."""
    cleaned = feature_dataset(tx, holidays, cfg, calendar=calendar, metadata=metadata)
    wide, run = train_and_forecast(cleaned, cfg)
    # the latest rows hold the global max date of the cleaned set: reuse the known value
    return sheet_names(report_long(wide, cfg, run.max_date), cfg), run


def rows_lost(tx: DataFrame, cfg: ForecastConfig) -> dict[str, int]:
    """Values that coercion turned into missing ones, and C8 then drops: one pass over two columns."""
    lost = [F.count_if(F.col(c).isNotNull() & (F.trim(F.col(c).cast("string")) != "") & read.isNull()).alias(c)
            for c, read in (("date", to_date_lenient(tx, "date", cfg.date_formats)), ("dispense", to_number(tx, "dispense")))]
    return tx.agg(*lost).first().asDict()


def read_dates(df: DataFrame, cfg: ForecastConfig) -> DataFrame:
    """A table with its text dates read in the configured formats."""
    return df.withColumn("date", to_date_lenient(df, "date", cfg.date_formats)) if "date" in df.columns else df


def run(spark: SparkSession, args: argparse.Namespace) -> ForecastRun:
    overrides = {"max_iter": args.max_iter} if args.max_iter else {}
    cfg = preset(args.preset, **overrides)
    if args.date_formats:
        cfg = cfg.with_(date_formats=tuple(args.date_formats))
    options = {"header": "true"} if args.input_format == "csv" else {}
    tx = read_parts(spark, args.transactions, args.input_format, None, **options)
    require_columns(tx, TRANSACTION_COLUMNS, "transactions")
    lost = rows_lost(tx, cfg)
    print(f"rows whose date or amount could not be read: {lost['date']}, {lost['dispense']}")
    holidays, calendar, metadata = (
        read_dates(read_table(spark, path, args.input_format, **options), cfg) if path else None
        for path in (args.holidays, args.calendar, args.metadata))
    report, result = forecast_report(tx, cfg, holidays, calendar, metadata)
    write_report(report, args.out, args.format, cfg.max_rows_per_sheet)
    release()
    return result


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(description=__doc__)
    p.add_argument("--transactions", required=True, nargs="+", help="one path for each part; parts are stacked by column name")
    p.add_argument("--date-formats", nargs="*", help="tried in order, e.g. yyyy-MM-dd dd-MMM-yyyy")
    p.add_argument("--holidays")
    p.add_argument("--calendar")
    p.add_argument("--metadata")
    p.add_argument("--out", required=True)
    p.add_argument("--preset", default="v1", choices=["v0", "v1", "v2"])
    p.add_argument("--format", default="parquet", choices=["parquet", "csv"])
    p.add_argument("--input-format", default="parquet")
    p.add_argument("--max-iter", type=int, default=0)
    args = p.parse_args(argv)
    spark = build_session()
    result = run(spark, args)
    for h in result.horizons:
        print(f"{h.label}: train={h.train_rows} val={h.val_rows} trees={h.trees} "
              f"early_stopping={h.early_stopping} skipped={h.skipped}")


if __name__ == "__main__":
    main()
