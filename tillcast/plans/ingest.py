"""Ingest job: raw parts and dimension tables -> validated Parquet.

    python -m tillcast.plans.ingest --out FOLDER --transactions PATH... [--holidays PATH] [--metadata PATH]
        [--input-format parquet|csv]

Transactions: every path is one part (S1), counted in the pass that writes them (S2), checked for its required columns
(S4) and written (S5); parts may order their columns as they like. Holidays: checked (S3),
dates read strictly (C4), distinct rows (H1). Metadata: checked, one table (S7).
"""

from __future__ import annotations

import argparse

from pyspark.sql import Observation, SparkSession
from pyspark.sql import functions as F

from tillcast.operators.holidays import distinct_holidays
from tillcast.operators.metadata import METADATA_COLUMNS
from tillcast.session import build_session
from tillcast.sources.readers import TRANSACTION_COLUMNS, read_parts, read_table, require_columns
from tillcast.sources.sinks import write_parquet


def ingest(spark: SparkSession, out: str, transactions: list[str], holidays: str | None = None, metadata: str | None = None,
           fmt: str = "csv") -> dict[str, int]:
    """Writes ``out``/transactions, /holiday_master and /atm_metadata; returns parts and rows read."""
    options = {"header": "true"} if fmt == "csv" else {}
    tx = read_parts(spark, transactions, fmt, "part", **options)
    require_columns(tx, TRANSACTION_COLUMNS, "transactions")
    counts = Observation()  # filled by the pass that writes
    write_parquet(tx.observe(counts, F.count(F.lit(1)).alias("n_rows"), F.size(F.collect_set("part")).cast("long").alias("n_parts")),
                  f"{out}/transactions")
    if holidays:
        write_parquet(distinct_holidays(read_table(spark, holidays, fmt, **options)), f"{out}/holiday_master")
    if metadata:
        table = read_table(spark, metadata, fmt, **options)
        require_columns(table, METADATA_COLUMNS, "atm_metadata")
        write_parquet(table, f"{out}/atm_metadata")
    return {"n_parts": counts.get["n_parts"], "n_rows": counts.get["n_rows"]}


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    p.add_argument("--out", required=True)
    p.add_argument("--transactions", required=True, nargs="+")
    p.add_argument("--holidays")
    p.add_argument("--metadata")
    p.add_argument("--input-format", default="csv", choices=["parquet", "csv"])
    args = p.parse_args(argv)
    counts = ingest(build_session(), args.out, args.transactions, args.holidays, args.metadata, args.input_format)
    print(f"{counts['n_parts']} parts, {counts['n_rows']} rows")


if __name__ == "__main__":
    main()
