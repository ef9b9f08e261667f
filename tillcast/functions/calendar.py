"""Calendar, salary and compound flags (P1-P11) as built-in expressions.

A missing date yields NULL parts and 0 in every flag, like comparisons with a
missing value in the reference.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def flag(pred: Column) -> Column:
    """Boolean predicate -> 0/1 INT, NULL counted as false."""
    return F.coalesce(pred, F.lit(False)).cast("int")


def is_one(name: str) -> Column:
    return F.col(name) == 1


def calendar_columns(date: str = "date") -> dict[str, Column]:
    """day_of_week (Mon=0), day_of_month, month, friday/weekend and salary flags."""
    d = F.col(date)
    dow = F.weekday(d)
    dom = F.dayofmonth(d)
    return {
        "day_of_week": dow,
        "day_of_month": dom,
        "month": F.month(d),
        "is_friday": flag(dow == 4),
        "is_weekend": flag(dow.isin(5, 6)),
        "is_salary_week": flag(dom.between(1, 7)),
        "is_monthend_salary": flag(dom.between(28, 31)),
        "is_salary_period": flag(dom.between(1, 7) | dom.between(28, 31)),
    }


def compound_columns() -> dict[str, Column]:
    """Salary interactions; needs is_holiday and is_long_weekend."""
    salary = is_one("is_salary_period")
    return {
        "is_salary_friday": flag(salary & is_one("is_friday")),
        "is_salary_weekend": flag(salary & is_one("is_weekend")),
        "is_salary_weekend_holiday": flag(
            salary & (is_one("is_weekend") | is_one("is_friday")) & is_one("is_holiday")),
        "is_salary_long_weekend": flag(salary & is_one("is_long_weekend")),
    }
