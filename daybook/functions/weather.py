"""Daily-measure features (F23-F34): categories, thresholds, felt value,
good/bad-day rules, interactions.

Null logic follows the reference's pandas semantics: a comparison with a
missing value is false, so every atomic test is wrapped in
``coalesce(test, false)``; category rules keep their own null behaviour
(reference defect D17: ``cut`` rules give null, the season table falls back
to its fallback label).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.quantiles import Selection, selected


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _t(cond: Column) -> Column:
    """pandas-style comparison: null is false."""
    return F.coalesce(cond, F.lit(False))


def cut_right(x, edges: list[float], labels: list[str]) -> Column:
    """pd.cut with right-closed bins (-inf, e1], (e1, e2], ..., (ek, inf);
    null stays null.  F23 uses edges (10, 20), F24 (5, 15, 25)."""
    v = _c(x)
    expr = None
    for e, lab in zip(edges, labels):
        expr = F.when(v <= e, F.lit(lab)) if expr is None else expr.when(v <= e, F.lit(lab))
    return F.when(v.isNull(), F.lit(None).cast("string")).otherwise(expr.otherwise(F.lit(labels[-1])))


# Base temperature categories of the reference.
BASE_EDGES, BASE_LABELS = [10, 20], ["cold", "mild", "warm"]            # F23
FOUR_EDGES, FOUR_LABELS = [5, 15, 25], ["cold", "mild", "warm", "hot"]  # F24

# Season-dependent temperature tables (F25), each season maps
# to left-closed [lo, hi) ranges for cold, mild, warm; unmatched values (and
# nulls) take the fallback label.
SEASON_TEMP_TABLES = {
    "preparation": {"winter": (5, 10), "spring": (10, 15), "summer": (15, 20), "fall": (8, 13)},
    "hybrid": {"winter": (5, 12), "spring": (10, 18), "summer": (15, 23), "fall": (8, 15)},
}
SEASON_TEMP_FALLBACK = "mild"
# Feature-selection variant: winter (0, 8), spring and fall (8, 18), summer
# (15, 25) with a null temperature falling through to "warm".
SELECTION_TEMP_TABLE = {"winter": (0, 8), "spring": (8, 18), "summer": (15, 25), "fall": (8, 18)}
SELECTION_TEMP_FALLBACK = "warm"


def season_temp_category(temp, season, table: dict, fallback: str) -> Column:
    """cold below lo, mild in [lo, hi), warm from hi, by season; rows
    matching no range (null temperature) get ``fallback``."""
    t, s = _c(temp), _c(season)
    expr = None
    for name, (lo, hi) in table.items():
        for lab, cond in (("cold", t < lo), ("mild", (t >= lo) & (t < hi)), ("warm", t >= hi)):
            c = (s == name) & _t(cond)
            expr = F.when(c, F.lit(lab)) if expr is None else expr.when(c, F.lit(lab))
    return expr.otherwise(F.lit(fallback))


def threshold_flags(temp, warm: float = 20, cold: float = 10) -> dict[str, Column]:
    """warm (>= warm), mild ([cold, warm)), cold (< cold) as 0/1."""
    t = _c(temp)
    return {"temp_warm": _t(t >= warm).cast("int"),
            "temp_mild": _t((t >= cold) & (t < warm)).cast("int"),
            "temp_cold": _t(t < cold).cast("int")}


def quantile_category(x, edges: Column, labels=("very_cold", "cold", "mild", "warm", "hot")) -> Column:
    """qcut into 5 bins by the quantile edges (an array column of 4
    values, usually a scalar subquery over the train split)."""
    v = _c(x)
    expr = None
    for i, lab in enumerate(labels[:-1]):
        cond = v <= edges.getItem(i)
        expr = F.when(cond, F.lit(lab)) if expr is None else expr.when(cond, F.lit(lab))
    return F.when(v.isNull(), F.lit(None).cast("string")).otherwise(expr.otherwise(F.lit(labels[-1])))


def quantile_edges(train: DataFrame, col: str, probs=(0.2, 0.4, 0.6, 0.8), select: bool | Selection = False) -> Column:
    """Exact quantile edges of ``train[col]`` as a scalar subquery
    (reference defect D16: fitted on train, applied to every split); by
    distributed selection where ``select`` is set (or a ``Selection`` of
    ``train``), for frames of any size."""
    if select:
        return F.array(*selected(train, [col], list(probs), select)[col])
    return train.select(F.percentile(col, F.array(*[F.lit(p) for p in probs]))).scalar()


def felt_simple(temp, wind, k: float = 0.2) -> Column:
    """T - 0.2 W."""
    return _c(temp) - k * _c(wind)


def felt_piecewise(temp, wind, humidity: float = 0.5) -> Column:
    """wind chill below 10, heat index (constant humidity) above 20,
    the temperature itself in between."""
    t, w = _c(temp), _c(wind)
    wp = F.pow(w, 0.16)
    chill = 13.12 + 0.6215 * t - 11.37 * wp + 0.3965 * t * wp
    h = humidity
    # The published coefficients of wind chill (above) and heat index.
    heat = (-8.78469475556 + 1.61139411 * t + 2.33854883889 * h - 0.14611605 * t * h
            - 0.012308094 * t * t - 0.0164248277778 * h * h + 0.002211732 * t * t * h
            + 0.00072546 * t * h * h - 0.000003582 * t * t * h * h)
    return F.when(t < 10, chill).when(t > 20, heat).otherwise(t)


def _mentions(desc, terms) -> Column:
    d = _c(desc)
    out = F.lit(False)
    for term in terms:
        out = out | _t(d.contains(term))
    return out


def good_weather(temp, cloud, desc, rain_terms, snow_terms, t_min: float = 15,
                 c_max: float = 5) -> Column:
    """T >= 15, cloud <= 5, description mentions neither rain nor snow
    (a missing description counts as neither)."""
    return (_t(_c(temp) >= t_min) & _t(_c(cloud) <= c_max)
            & ~_mentions(desc, rain_terms) & ~_mentions(desc, snow_terms))


def very_good_bad_weather(temp, cloud, desc=None, rain_terms=(), snow_terms=()) -> dict[str, Column]:
    """very good (T >= 20, cloud <= 3, no rain/snow) and bad (T < 10 or
    cloud > 6 or rain or snow).  Without ``desc`` the later rule set is used:
    good T > 15 & cloud < 5, very good T > 20 & cloud < 3, bad T < 10 |
    cloud > 6."""
    t, c = _c(temp), _c(cloud)
    if desc is None:
        return {"good": _t(t > 15) & _t(c < 5), "very_good": _t(t > 20) & _t(c < 3),
                "bad": _t(t < 10) | _t(c > 6)}
    wet = _mentions(desc, rain_terms) | _mentions(desc, snow_terms)
    return {"very_good": _t(t >= 20) & _t(c <= 3) & ~wet,
            "bad": _t(t < 10) | _t(c > 6) | wet}


def comfort_flags(temp, cloud, wind) -> dict[str, Column]:
    """F32: comfort (18 <= T <= 25, cloud <= 5, wind <= 15) and discomfort
    (T < 5 or T > 30 or cloud >= 7 or wind >= 25)."""
    t, c, w = _c(temp), _c(cloud), _c(wind)
    return {"comfort": _t(t.between(18, 25)) & _t(c <= 5) & _t(w <= 15),
            "discomfort": _t(t < 5) | _t(t > 30) | _t(c >= 7) | _t(w >= 25)}


def interactions(temp, wind, cloud, winter=None) -> dict[str, Column]:
    """T x wind, T x cloud, wind x cloud (and T x winter flag)."""
    t, w, c = _c(temp), _c(wind), _c(cloud)
    out = {"temp_wind": t * w, "temp_cloud": t * c, "wind_cloud": w * c}
    if winter is not None:
        out["temp_winter"] = t * _c(winter).cast("double")
    return out


def weekend_interactions(day, temp) -> dict[str, Column]:
    """summer / winter / warm (T >= 20) / cold (T <= 10) weekend."""
    d, t = _c(day), _c(temp)
    we = F.weekday(d) >= 5
    m = F.month(d)
    return {"summer_weekend": m.isin(6, 7, 8) & we, "winter_weekend": m.isin(12, 1, 2) & we,
            "warm_weekend": _t(t >= 20) & we, "cold_weekend": _t(t <= 10) & we}
