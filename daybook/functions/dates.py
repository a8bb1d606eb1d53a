"""Calendar feature expressions (F1-F22).  All are built-in column
functions, evaluated inside whole-stage codegen; nothing per row in Python.
Weekday is Monday = 0 (``weekday``, not ``dayofweek``)."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# English and German weekday names, Monday first.
WEEKDAY_NAMES_EN = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
WEEKDAY_NAMES_DE = ["Montag", "Dienstag", "Mittwoch", "Donnerstag", "Freitag", "Samstag", "Sonntag"]


def _c(day) -> Column:
    return F.col(day) if isinstance(day, str) else day


def weekday_name(day, names: list[str] = WEEKDAY_NAMES_EN) -> Column:
    """locale-free weekday name by lookup on the Monday = 0 index."""
    return F.element_at(F.array(*[F.lit(n) for n in names]), F.weekday(_c(day)) + 1)


def is_weekend(day) -> Column:
    """F5."""
    return F.weekday(_c(day)) >= 5


def month_edges(day) -> dict[str, Column]:
    """month / quarter start and end flags."""
    d = _c(day)
    q_start = F.trunc(d, "quarter")
    return {
        "is_month_start": d == F.trunc(d, "MM"),
        "is_month_end": d == F.last_day(d),
        "is_quarter_start": d == q_start,
        "is_quarter_end": d == F.date_sub(F.add_months(q_start, 3), 1),
    }


def approx_month_edges(day, start_max: int = 3, end_min: int = 28) -> dict[str, Column]:
    """day of month <= 3 / >= 28."""
    dom = F.dayofmonth(_c(day))
    return {"near_month_start": dom <= start_max, "near_month_end": dom >= end_min}


def month_third(day, labels=("start", "middle", "end")) -> Column:
    """F8: right-closed bins (0,10], (10,20], (20,31] of the day of month
    (``Bucketizer`` is left-closed and would put the 10th in the wrong bin)."""
    dom = F.dayofmonth(_c(day))
    return (F.when(dom <= 10, F.lit(labels[0])).when(dom <= 20, F.lit(labels[1]))
            .otherwise(F.lit(labels[2])))


def week_of_month(day) -> Column:
    """(day - 1) div 7 + 1."""
    return F.floor((F.dayofmonth(_c(day)) - 1) / 7).cast("int") + 1


def payment_cycle(day, early: int = 5, late: int = 25) -> dict[str, Column]:
    """<= 5 / 6-24 / >= 25."""
    dom = F.dayofmonth(_c(day))
    return {"cycle_start": dom <= early, "cycle_mid": (dom > early) & (dom < late),
            "cycle_end": dom >= late}


def month_distances(day) -> dict[str, Column]:
    """distance from month start and middle, scaled by half the month
    length, clipped to [0, 1]."""
    d = _c(day)
    dom = F.dayofmonth(d)
    half = F.dayofmonth(F.last_day(d)) / 2.0
    clip = lambda c: F.least(F.greatest(c, F.lit(0.0)), F.lit(1.0))
    return {"dist_from_start": clip((dom - 1) / half),
            "dist_from_middle": clip(F.abs(dom - half) / half)}


# Season names.
SEASONS = ("winter", "spring", "summer", "fall")


def season_meteo(day) -> Column:
    """Dec-Feb winter, Mar-May spring, Jun-Aug summer, Sep-Nov fall."""
    m = F.month(_c(day))
    return (F.when(m.isin(12, 1, 2), F.lit("winter")).when(m.isin(3, 4, 5), F.lit("spring"))
            .when(m.isin(6, 7, 8), F.lit("summer")).otherwise(F.lit("fall")))


def season_quarter(day) -> Column:
    """right-closed month bins (0,3], (3,6], (6,9], (9,12]: Jan-Mar
    winter, Apr-Jun spring, Jul-Sep summer, Oct-Dec fall."""
    m = F.month(_c(day))
    return (F.when(m <= 3, F.lit("winter")).when(m <= 6, F.lit("spring"))
            .when(m <= 9, F.lit("summer")).otherwise(F.lit("fall")))


def season_flags(day) -> dict[str, Column]:
    """one flag per meteorological season."""
    s = season_meteo(day)
    return {f"is_{n}": s == n for n in SEASONS}


def is_new_years_eve(day) -> Column:
    """F15."""
    d = _c(day)
    return (F.month(d) == 12) & (F.dayofmonth(d) == 31)


def month_day(day) -> Column:
    """F16: 'MM-dd'."""
    return F.date_format(_c(day), "MM-dd")


def month_bucket(day) -> Column:
    """first day of the month."""
    return F.trunc(_c(day), "MM")


def year_offset(day, base: int) -> Column:
    """year - base."""
    return F.year(_c(day)) - base


def normalized_year(df: DataFrame, day: str = "day") -> Column:
    """(year - min) / (max - min) over ``df``; min and max are scalar
    subqueries (computed once, no join)."""
    lo = df.select(F.min(F.year(day))).scalar()
    hi = df.select(F.max(F.year(day))).scalar()
    return (F.year(F.col(day)) - lo) / (hi - lo)


def cyclic(x: Column, period: float) -> tuple[Column, Column]:
    """sin and cos of 2*pi*x/period."""
    a = 2 * math.pi * x / period
    return F.sin(a), F.cos(a)


def cyclic_calendar(day) -> dict[str, Column]:
    """month/12, day/31, ISO week/52 and weekday/7 encodings."""
    d = _c(day)
    out = {}
    for name, x, p in (("month", F.month(d), 12), ("day", F.dayofmonth(d), 31),
                       ("week", F.weekofyear(d), 52), ("weekday", F.weekday(d), 7)):
        s, c = cyclic(x, p)
        out[f"{name}_sin"], out[f"{name}_cos"] = s, c
    return out


def fourier_terms(day, epoch: str, n: int = 4, periods=(("weekly", 7.0), ("yearly", 365.25))
                  ) -> dict[str, Column]:
    """``n`` harmonics of each period, time = days since ``epoch``."""
    t = F.datediff(_c(day), F.lit(epoch).cast("date")).cast("double")
    out = {}
    for name, p in periods:
        for i in range(1, n + 1):
            a = 2 * math.pi * i * t / p
            out[f"{name}_sin_{i}"] = F.sin(a)
            out[f"{name}_cos_{i}"] = F.cos(a)
    return out


def days_since_start(df: DataFrame, day: str = "day") -> Column:
    """days since the first day of ``df`` (scalar subquery)."""
    return F.datediff(F.col(day), df.select(F.min(day)).scalar())


def calendar_features(df: DataFrame, day: str = "day") -> DataFrame:
    """F1-F18 bundle: every calendar column the models use, as one select."""
    d = F.col(day)
    cols = {
        "year": F.year(d), "month": F.month(d), "dom": F.dayofmonth(d), "quarter": F.quarter(d),
        "weekday": F.weekday(d), "iso_week": F.weekofyear(d), "weekday_name": weekday_name(d),
        "weekday_name_de": weekday_name(d, WEEKDAY_NAMES_DE),
        "is_weekend": is_weekend(d).cast("int"), "month_third": month_third(d),
        "week_of_month": week_of_month(d), "season": season_meteo(d),
        "season_q": season_quarter(d), "is_nye": is_new_years_eve(d).cast("int"),
        "month_day": month_day(d), "month_start": month_bucket(d),
    }
    for k, v in {**month_edges(d), **approx_month_edges(d), **payment_cycle(d),
                 **season_flags(d)}.items():
        cols[k] = v.cast("int")
    return df.select("*", *[v.alias(k) for k, v in cols.items()])
