"""Views over the driver's test tables that play the reference's inputs.

Each view is derived by Spark from the given tables, so its work grows with them:
  tx_dense   machine-day panel from ``events`` (near-daily, January 2024)
  tx_long    machine-day panel from ``lineitem`` x ``supplier`` x ``nation`` (1995-2001)
  tx_skewed  tx_long with one machine holding about a third of all rows
  tx_dirty   raw text amounts/dates/states from ``events`` (cleaning cases)
  tx_inactive / tx_nulls   tx_dense with zero, missing, negative or scattered NULL amounts
  holidays   holiday master: fixed (month, day, state, name) entries placed on the
             years and states present in a panel
  calendar   country calendar (date, holiday_name): the every-state entries
  metadata   machine metadata from ``supplier``
The same definitions are written as SQL in ``tillcast.plans.oracle``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillcast.operators.tasks import dealt

# ---------------------------------------------------------------------------
# The holiday entries of the test views.
# (month, day, state or "*" for every state present that year, holiday name)
# ---------------------------------------------------------------------------
HOLIDAY_ENTRIES = [
    (1, 1, "*", "New Year Bank Holiday"),
    (1, 8, "NATION_8", "Financial Year End"),
    (1, 10, "NATION_10", "Good Friday"),
    (1, 11, "NATION_11", "Gandhi Jayanti"),
    (1, 13, "NATION_3", "2nd Sat Holiday"),
    (1, 15, "NATION_1", "Pongal"),
    (1, 15, "NATION_1", "Makar Sankranti"),
    (1, 17, "NATION_4", None),
    (1, 22, " nation_7 ", "Ugadi"),
    (1, 25, "NATION_5", "Eid-ul-Fitr"),
    (1, 26, "*", "Republic Day"),
    (1, 26, "NATION_2", "Republic Day"),
    (1, 29, "NATION_9", "Diwali Laxmi Pujan"),
    (1, 30, None, "Bank Closing Day"),
    (3, 31, "*", "Annual Closing"),
    (4, 14, "NATION_12", "Ambedkar Jayanti"),
    (8, 15, "*", "Independence Day"),
    (10, 2, "*", "Gandhi Jayanti"),
    (10, 24, "NATION_5", "Dussehra"),
    (11, 12, "NATION_6", "Diwali"),
    (12, 25, "*", "Christmas"),
]

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _cents(c) -> F.Column:
    return F.round(c * 100).cast("bigint")


def tx_dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B1: one row per (user, day) of ``events``; amount = summed value in cents."""
    ev = table(spark, sf_dir, "events")
    return (ev.groupBy(
        F.concat(F.lit("ATM_"), F.col("user_id").cast("string")).alias("atm_id"),
        F.to_date("ts").alias("date"),
        F.concat(F.lit("NATION_"), (F.col("user_id") % 25).cast("string")).alias("state"))
        .agg(F.sum(_cents(F.col("value"))).cast("bigint").alias("dispense")))


def tx_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B2: one row per (supplier, ship day) of ``lineitem``; state = the supplier's nation."""
    li = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_shipdate", "l_extendedprice")
    su = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    na = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    j = (li.join(su, li.l_suppkey == su.s_suppkey).join(na, su.s_nationkey == na.n_nationkey))
    rows = j.select(
        F.concat(F.lit("ATM_"), F.col("l_suppkey").cast("string")).alias("atm_id"),
        F.to_date("l_shipdate").alias("date"),
        F.col("n_name").alias("state"), _cents(F.col("l_extendedprice")).alias("cents"))
    # nearly every row is a group of its own: summed after the shuffle, in tasks of a bounded number of rows
    return (dealt(rows, li.count(), "atm_id", "date", "state").groupBy("atm_id", "date", "state")
            .agg(F.sum("cents").cast("bigint").alias("dispense")))


# Nations whose suppliers are merged into one machine in the skewed panel (8 of 25).
HOT_NATIONS = tuple(f"NATION_{i}" for i in range(8))


def tx_skewed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B2 with every row of the suppliers of 8 nations relabelled to one machine
    ``ATM_HOT``: one key holding about a third of all rows, many rows per day."""
    t = tx_long(spark, sf_dir)
    return t.withColumn("atm_id", F.when(F.col("state").isin(*HOT_NATIONS), F.lit("ATM_HOT"))
                        .otherwise(F.col("atm_id")))


def tx_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw event rows with text amounts, text dates and untidy states."""
    ev = table(spark, sf_dir, "events")
    k = F.col("event_id") % 50
    amount = (F.when(k == 0, "n/a").when(k == 1, "").when(k == 2, "1,000").when(k == 3, " 12 ")
              .when(k == 4, "1e3").otherwise(F.col("value").cast("string")))
    day = F.when(k == 5, "bad").when(k == 6, "15/01/2024").otherwise(F.date_format("ts", "yyyy-MM-dd"))
    state = F.concat(F.lit("NATION_"), (F.col("user_id") % 25).cast("string"))
    state = (F.when(k == 7, F.concat(F.lower(state), F.lit(" "))).when(k == 8, F.concat(F.lit("\t"), state))
             .when(k == 9, F.lit(None).cast("string")).otherwise(state))
    return ev.select(
        "event_id",
        F.concat(F.lit("ATM_"), F.col("user_id").cast("string")).alias("atm_id"),
        day.alias("date"), amount.alias("dispense"), state.alias("state"))


def tx_inactive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zero, missing and negated amounts for three classes of machines."""
    tx = tx_dense(spark, sf_dir)
    uid = F.regexp_extract("atm_id", r"(\d+)$", 1).cast("bigint") % 10
    amount = (F.when(uid == 0, F.lit(0).cast("bigint")).when(uid == 1, F.lit(None).cast("bigint"))
              .when(uid == 2, -F.col("dispense")).otherwise(F.col("dispense")))
    return tx.withColumn("dispense", amount)


def tx_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scattered NULL amounts, (day + user) % 9 = 0."""
    tx = tx_dense(spark, sf_dir)
    uid = F.regexp_extract("atm_id", r"(\d+)$", 1).cast("bigint")
    hit = ((F.dayofmonth("date") + uid) % 9) == 0
    return tx.withColumn("dispense", F.when(hit, F.lit(None).cast("bigint")).otherwise(F.col("dispense")))


def _entries() -> F.Column:
    return F.array(*[
        F.struct(F.lit(m).alias("m"), F.lit(d).alias("d"), F.lit(s).cast("string").alias("spec"),
                 F.lit(n).cast("string").alias("holiday_name"))
        for m, d, s, n in HOLIDAY_ENTRIES])


def holidays_for(tx: DataFrame) -> DataFrame:
    """Holiday master placed on the years and states of a panel.

    "*" entries go to every state present in that year; the others keep their
    literal state text (possibly untidy or NULL). Generated with ``explode``.
    """
    ys = tx.where(F.col("date").isNotNull()).select(F.year("date").alias("y"), "state").distinct()
    every = (ys.select("y", "state", F.explode(_entries()).alias("e"))
             .where(F.col("e.spec") == "*")
             .select(F.make_date("y", "e.m", "e.d").alias("date"), "state", "e.holiday_name"))
    years = ys.select("y").distinct()
    named = (years.select("y", F.explode(_entries()).alias("e"))
             .where(F.col("e.spec").isNull() | (F.col("e.spec") != "*"))
             .select(F.make_date("y", "e.m", "e.d").alias("date"), F.col("e.spec").alias("state"),
                     "e.holiday_name"))
    return every.unionByName(named)


def calendar_for(tx: DataFrame) -> DataFrame:
    """Country calendar (date, holiday_name) from the every-state entries."""
    years = tx.where(F.col("date").isNotNull()).select(F.year("date").alias("y")).distinct()
    return (years.select("y", F.explode(_entries()).alias("e"))
            .where(F.col("e.spec") == "*")
            .select(F.make_date("y", "e.m", "e.d").alias("date"), "e.holiday_name"))


def metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per supplier; NULL location for every 7th key, percent strings."""
    su = table(spark, sf_dir, "supplier")
    key = F.col("s_suppkey")
    loc = (F.when(key % 7 == 0, F.lit(None).cast("string"))
           .otherwise(F.element_at(F.array(F.lit("Urban"), F.lit("Semi-Urban"), F.lit("Rural")),
                                   (F.col("s_nationkey") % 3 + 1).cast("int"))))
    return su.select(
        F.concat(F.lit("ATM_"), key.cast("string")).alias("atm_id"),
        loc.alias("location_type"),
        F.concat(F.lit("T"), (F.col("s_nationkey") % 3 + 1).cast("string")).alias("city_tier"),
        F.concat((key % 101).cast("string"), F.lit("%")).alias("uptime_pct"),
        F.concat((100 - key % 101).cast("string"), F.lit("%")).alias("downtime_pct"))
