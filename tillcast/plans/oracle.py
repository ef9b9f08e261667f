"""Independent SQL (DuckDB dialect) for every SQL-checkable query of the catalog.

The test tables are pre-registered views in the checker; the panels, holiday master,
calendar and metadata views of ``tillcast.sources.testviews`` are rebuilt here as CTEs.
Amounts are integer cents carried as DOUBLE, so sums and means are exact in both engines.
"""

from __future__ import annotations

from tillcast.config import HORIZONS
from tillcast.sources.testviews import HOLIDAY_ENTRIES

# Fixed values, written here again so that an error in the engine's own lists would show.
BANK_PATTERNS = ["2nd sat", "4th sat", "annual closing", "financial year end", "closing day"]
FESTIVAL_PATTERNS = ["holi", "eid", "ramzan", "bakri", "moharram", "pongal", "bihu", "navami", "mahashivratri", "good friday",
                     "christmas", "diwali", "dussehra", "durga", "ganesh", "onam"]
NATIONAL_PATTERNS = ["republic day", "independence day", "gandhi jayanti"]
MAJOR_FESTIVAL_REGEX = "holi|diwali|eid|durga|dussehra|christmas|onam"
NUMERIC_TEXT = r"(?i)^\s*[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf(inity)?)\s*$"


def _lit(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    return str(v)


ENTRIES = ("(SELECT * FROM (VALUES " + ", ".join(
    "(" + ", ".join(_lit(x) for x in e) + ")" for e in HOLIDAY_ENTRIES)
    + ") AS t(m, d, spec, holiday_name))")

TX_DENSE = """SELECT concat('ATM_', user_id) AS atm_id, CAST(ts AS DATE) AS date,
    concat('NATION_', user_id % 25) AS state,
    CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS dispense
  FROM events GROUP BY 1, 2, 3"""

TX_LONG = """SELECT concat('ATM_', l_suppkey) AS atm_id, CAST(l_shipdate AS DATE) AS date, n_name AS state,
    CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS dispense
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
  GROUP BY 1, 2, 3"""

TX_SKEWED = """SELECT CASE WHEN state IN ('NATION_0', 'NATION_1', 'NATION_2', 'NATION_3', 'NATION_4', 'NATION_5',
    'NATION_6', 'NATION_7') THEN 'ATM_HOT' ELSE atm_id END AS atm_id, date, state, dispense FROM tx_long"""

TX_DIRTY = """SELECT event_id, concat('ATM_', user_id) AS atm_id,
    CASE event_id % 50 WHEN 5 THEN 'bad' WHEN 6 THEN '15/01/2024' ELSE strftime(ts, '%Y-%m-%d') END AS date,
    CASE event_id % 50 WHEN 0 THEN 'n/a' WHEN 1 THEN '' WHEN 2 THEN '1,000' WHEN 3 THEN ' 12 '
         WHEN 4 THEN '1e3' ELSE CAST(value AS VARCHAR) END AS dispense,
    CASE event_id % 50 WHEN 7 THEN lower(concat('NATION_', user_id % 25)) || ' '
         WHEN 8 THEN chr(9) || concat('NATION_', user_id % 25) WHEN 9 THEN NULL
         ELSE concat('NATION_', user_id % 25) END AS state
  FROM events"""

TX_INACTIVE = """SELECT atm_id, date, state,
    CASE CAST(regexp_extract(atm_id, '(\\d+)$', 1) AS BIGINT) % 10
      WHEN 0 THEN CAST(0 AS BIGINT) WHEN 1 THEN CAST(NULL AS BIGINT) WHEN 2 THEN -dispense
      ELSE dispense END AS dispense
  FROM tx_dense"""

TX_NULLS = """SELECT atm_id, date, state,
    CASE WHEN (day(date) + CAST(regexp_extract(atm_id, '(\\d+)$', 1) AS BIGINT)) % 9 = 0
         THEN CAST(NULL AS BIGINT) ELSE dispense END AS dispense
  FROM tx_dense"""

METADATA = """SELECT concat('ATM_', s_suppkey) AS atm_id,
    CASE WHEN s_suppkey % 7 = 0 THEN NULL
         ELSE ['Urban', 'Semi-Urban', 'Rural'][s_nationkey % 3 + 1] END AS location_type,
    concat('T', s_nationkey % 3 + 1) AS city_tier,
    concat(s_suppkey % 101, '%') AS uptime_pct,
    concat(100 - s_suppkey % 101, '%') AS downtime_pct
  FROM supplier"""


def holidays_sql(tx: str) -> str:
    return f"""SELECT make_date(ys.y, e.m, e.d) AS date, ys.state, e.holiday_name
  FROM (SELECT DISTINCT year(date) AS y, state FROM {tx} WHERE date IS NOT NULL) ys, {ENTRIES} e
  WHERE e.spec = '*'
UNION ALL
SELECT make_date(yy.y, e.m, e.d) AS date, e.spec AS state, e.holiday_name
  FROM (SELECT DISTINCT year(date) AS y FROM {tx} WHERE date IS NOT NULL) yy, {ENTRIES} e
  WHERE e.spec IS NULL OR e.spec <> '*'"""


def calendar_sql(tx: str) -> str:
    return f"""SELECT make_date(yy.y, e.m, e.d) AS date, e.holiday_name
  FROM (SELECT DISTINCT year(date) AS y FROM {tx} WHERE date IS NOT NULL) yy, {ENTRIES} e
  WHERE e.spec = '*'"""


def _contains_any(col: str, pats: list[str]) -> str:
    return " OR ".join(f"contains({col}, {_lit(p)})" for p in pats)


def holiday_type_sql(name: str) -> str:
    low = f"lower({name})"
    return (f"CASE WHEN {_contains_any(low, BANK_PATTERNS)} THEN 'BANK' "
            f"WHEN {_contains_any(low, FESTIVAL_PATTERNS)} THEN 'FESTIVAL' "
            f"WHEN {_contains_any(low, NATIONAL_PATTERNS)} THEN 'NATIONAL' ELSE 'STATE' END")


def major_sql(name: str) -> str:
    return f"CAST(coalesce(regexp_matches(lower({name}), '{MAJOR_FESTIVAL_REGEX}'), false) AS INT)"


def num_sql(col: str) -> str:
    pat = NUMERIC_TEXT.replace("'", "''")
    return f"CASE WHEN regexp_matches({col}, '{pat}') THEN TRY_CAST(trim({col}) AS DOUBLE) END"


def norm_sql(col: str) -> str:
    return f"upper(regexp_replace({col}, '^\\s+|\\s+$', '', 'g'))"


def flag(pred: str) -> str:
    return f"CAST(coalesce({pred}, false) AS INT)"


ORDER = "date ASC NULLS LAST, state ASC NULLS LAST, holiday_name ASC NULLS LAST, dispense ASC NULLS LAST"
W = f"PARTITION BY atm_id ORDER BY {ORDER}"
W_LAST = ("PARTITION BY atm_id ORDER BY date DESC NULLS FIRST, state DESC NULLS FIRST, "
          "holiday_name DESC NULLS FIRST, dispense DESC NULLS FIRST")


def _roll(n: int, min_periods: int) -> str:
    f = f"OVER ({W} ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)"
    return (f"CASE WHEN count(dispense) {f} >= {min_periods} "
            f"THEN CAST(sum(dispense) {f} AS DOUBLE) / count(dispense) {f} END")


def feature_ctes(preset: str = "v1", tx: str = "tx_dense", holidays: str | None = None,
                 calendar: str | None = None, metadata: str | None = None,
                 calendar_years: tuple[int, ...] = (2024,), val_days: int | None = None) -> list[str]:
    """CTE list ending in: joined, feat, valid, tgt, cleaned, split (per preset)."""
    v0, v1, v2 = preset == "v0", preset == "v1", preset == "v2"
    min14 = 11 if v1 else 14
    val = val_days if val_days is not None else (30 if v0 else 7)
    ctes = []
    src = tx
    if v0:
        ctes.append(f"""meta_c AS (SELECT atm_id AS m_atm_id, location_type, city_tier,
  {num_sql("replace(uptime_pct, '%', '')")} AS uptime_pct,
  {num_sql("replace(downtime_pct, '%', '')")} AS downtime_pct FROM {metadata})""")
        ctes.append(f"txm AS (SELECT t.*, m.* EXCLUDE (m_atm_id) FROM {tx} t LEFT JOIN meta_c m ON t.atm_id = m.m_atm_id)")
        src = "txm"
    state_expr = norm_sql("state") if v1 else "state"
    ctes.append(f"""prep AS (SELECT * REPLACE (CAST(dispense AS DOUBLE) AS dispense, {state_expr} AS state) FROM {src})""")
    if v0:
        ctes.append("active AS (SELECT * FROM prep)")
    else:
        ctes.append("""active AS (SELECT * FROM prep WHERE atm_id IS NOT NULL
  QUALIFY sum(dispense) OVER (PARTITION BY atm_id) > 0)""")
    ctes.append(f"""cal AS (SELECT *, CAST(isodow(date) - 1 AS INT) AS day_of_week, CAST(day(date) AS INT) AS day_of_month,
  CAST(month(date) AS INT) AS month, {flag("isodow(date) = 5")} AS is_friday,
  {flag("isodow(date) IN (6, 7)")} AS is_weekend, {flag("day(date) BETWEEN 1 AND 7")} AS is_salary_week,
  {flag("day(date) BETWEEN 28 AND 31")} AS is_monthend_salary,
  {flag("day(date) BETWEEN 1 AND 7 OR day(date) BETWEEN 28 AND 31")} AS is_salary_period FROM active)""")
    if v0:
        years = ", ".join(str(y) for y in calendar_years)
        ctes.append(f"""hdim AS (SELECT date AS h_date, string_agg(DISTINCT holiday_name, '; ' ORDER BY holiday_name) AS h_name
  FROM {calendar} WHERE year(date) IN ({years}) GROUP BY date)""")
        ctes.append("""joined AS (SELECT c.*, coalesce(h.h_name, 'Regular Day') AS holiday_name,
  CAST(CASE WHEN h.h_date IS NULL THEN 0 ELSE 1 END AS INT) AS is_holiday
  FROM cal c LEFT JOIN hdim h ON c.date IS NOT DISTINCT FROM h.h_date)""")
    else:
        st = f", {norm_sql('state')} AS h_state" if v1 else ""
        ctes.append(f"""hdim AS (SELECT DISTINCT CAST(date AS DATE) AS h_date{st}, holiday_name AS h_name,
  {holiday_type_sql("holiday_name")} AS h_type, {major_sql("holiday_name")} AS h_major FROM {holidays})""")
        on = "c.date IS NOT DISTINCT FROM h.h_date" + (" AND c.state IS NOT DISTINCT FROM h.h_state" if v1 else "")
        ctes.append(f"""joined AS (SELECT c.*, coalesce(h.h_name, 'Regular Day') AS holiday_name,
  coalesce(h.h_type, 'NONE') AS holiday_type,
  CAST(CASE WHEN h.h_date IS NULL THEN 0 ELSE 1 END AS INT) AS is_holiday,
  CAST(coalesce(h.h_major, 0) AS INT) AS is_major_festival
  FROM cal c LEFT JOIN hdim h ON {on})""")
    ctes.append(f"""w1 AS (SELECT *, {flag("is_weekend = 1 OR is_holiday = 1")} AS off,
  CAST(coalesce(lead(is_holiday, 1) OVER ({W}), 0) AS INT) AS is_pre_holiday,
  lag(dispense, 1) OVER ({W}) AS dispense_lag_1, lag(dispense, 2) OVER ({W}) AS dispense_lag_2,
  lag(dispense, 7) OVER ({W}) AS dispense_lag_7,
  {_roll(7, 7)} AS dispense_roll_mean_7, {_roll(14, min14)} AS dispense_roll_mean_14 FROM joined)""")
    ctes.append(f"""w2 AS (SELECT *, CASE WHEN lag(off, 1) OVER ({W}) IS NULL OR lag(off, 1) OVER ({W}) <> off
  THEN 1 ELSE 0 END AS start FROM w1)""")
    ctes.append(f"""w3 AS (SELECT *, sum(start) OVER ({W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS blk FROM w2)""")
    ctes.append("""w4 AS (SELECT *, count(date) OVER (PARTITION BY atm_id, blk) AS blk_len FROM w3)""")
    ctes.append(f"""w5 AS (SELECT *, {flag("off = 1 AND blk_len >= 3")} AS is_long_weekend FROM w4)""")
    ctes.append(f"""feat AS (SELECT * EXCLUDE (off, start, blk, blk_len),
  {flag("is_salary_period = 1 AND is_friday = 1")} AS is_salary_friday,
  {flag("is_salary_period = 1 AND is_weekend = 1")} AS is_salary_weekend,
  {flag("is_salary_period = 1 AND (is_weekend = 1 OR is_friday = 1) AND is_holiday = 1")} AS is_salary_weekend_holiday,
  {flag("is_salary_period = 1 AND is_long_weekend = 1")} AS is_salary_long_weekend FROM w5)""")
    if v0:
        ctes.append("""feat_f AS (SELECT * REPLACE (coalesce(location_type, 'Unknown') AS location_type,
  coalesce(city_tier, 'Unknown') AS city_tier) FROM feat)""")
        req = ("atm_id", "date", "dispense", "uptime_pct", "downtime_pct")
        base = "feat_f"
    else:
        req = ("atm_id", "date", "dispense")
        base = "feat"
    ctes.append(f"valid AS (SELECT * FROM {base} WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in req) + ")")
    leads = ", ".join(f"lead(dispense, {k}) OVER ({W}) AS {t}" for _, t, k in HORIZONS)
    ctes.append(f"tgt AS (SELECT *, {leads} FROM valid)")
    ctes.append("cleaned AS (SELECT * FROM tgt WHERE dispense_lag_7 IS NOT NULL AND dispense_roll_mean_14 IS NOT NULL)")
    ctes.append(f"""split AS (SELECT *, CAST((SELECT max(date) FROM cleaned) - INTERVAL {val} DAY AS DATE) AS split_date,
  date > CAST((SELECT max(date) FROM cleaned) - INTERVAL {val} DAY AS DATE) AS is_val FROM cleaned)""")
    return ctes


def with_ctes(base: dict[str, str], ctes: list[str], select: str) -> str:
    head = [f"{k} AS ({v})" for k, v in base.items()]
    return "WITH " + ",\n".join(head + ctes) + "\n" + select


def dense(preset: str = "v1", tx: str = "tx_dense", **kw) -> tuple[dict[str, str], list[str]]:
    base = {"tx_dense": TX_DENSE}
    if tx == "tx_nulls":
        base["tx_nulls"] = TX_NULLS
    elif tx == "tx_inactive":
        base["tx_inactive"] = TX_INACTIVE
    elif tx == "tx_long":
        base = {"tx_long": TX_LONG}
    elif tx == "tx_skewed":
        base = {"tx_long": TX_LONG, "tx_skewed": TX_SKEWED}
    if preset == "v0":
        base["calendar"] = calendar_sql(tx)
        base["metadata"] = METADATA
        ctes = feature_ctes("v0", tx, calendar="calendar", metadata="metadata", **kw)
    else:
        base["holidays"] = holidays_sql(tx)
        ctes = feature_ctes(preset, tx, holidays="holidays", **kw)
    return base, ctes


def feature_query(select: str, preset: str = "v1", tx: str = "tx_dense", **kw) -> str:
    base, ctes = dense(preset, tx, **kw)
    return with_ctes(base, ctes, select)


def stand_in_report_ctes() -> list[str]:
    """Latest rows with stand-in predictions (rolling 14 / rolling 7 / lag 7), long format."""
    return [
        f"latest AS (SELECT * FROM cleaned QUALIFY row_number() OVER ({W_LAST}) = 1)",
        """wide AS (SELECT *, round_even(CASE WHEN dispense_roll_mean_14 < 0 THEN 0.0 ELSE dispense_roll_mean_14 END, 0) AS p1,
  round_even(CASE WHEN dispense_roll_mean_7 < 0 THEN 0.0 ELSE dispense_roll_mean_7 END, 0) AS p3,
  round_even(CASE WHEN dispense_lag_7 < 0 THEN 0.0 ELSE dispense_lag_7 END, 0) AS p7 FROM latest)""",
        """rlong AS (
  SELECT 'Next_Day' AS horizon, 1 AS k, atm_id, date, is_salary_period, is_long_weekend, holiday_name, p1 AS predicted_dispense_amount FROM wide
  UNION ALL SELECT 'Next_3_Days', 3, atm_id, date, is_salary_period, is_long_weekend, holiday_name, p3 FROM wide
  UNION ALL SELECT 'Next_Week', 7, atm_id, date, is_salary_period, is_long_weekend, holiday_name, p7 FROM wide)""",
        """report AS (SELECT horizon, atm_id, date AS reference_date, is_salary_period, is_long_weekend, holiday_name,
  predicted_dispense_amount,
  CAST((SELECT max(date) FROM latest) + k * INTERVAL 1 DAY AS DATE) AS forecast_date,
  strftime(CAST((SELECT max(date) FROM latest) + k * INTERVAL 1 DAY AS DATE), '%d-%b-%Y') AS forecast_for_date
  FROM rlong)""",
    ]
