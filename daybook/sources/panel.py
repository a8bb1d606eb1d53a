"""The daily panel and its daily side tables, built from the driver tables.

Mapping (see SURVEY 7.1):

* sales panel ``(day, grp, units, lines)``: ``lineitem`` joined to ``part``,
  ``day = to_date(l_shipdate)``, ``grp`` = number of the first word of
  ``p_type``, ``units = sum(l_quantity)`` (integral, so sums are exact).
* daily measures ``(day, n_orders, temp, wind, cloud, code)``: ``orders``
  per ``o_orderdate``.  Orders stop before the panel does, so a left join
  leaves real nulls for the imputation operators.
* code dictionary ``(code, description)``: the order priority split in its
  number and text.

The raw join is the only step that touches fact-sized data.  It is a plain
equi-join (no hint): the planner shuffles both sides on the part key, and
adaptive execution turns it into a broadcast at runtime when ``part`` is
small and splits a hot part key with the skew-join rule.  The aggregate to
(day, grp) combines map-side first, so a hot group only costs its partial
sums in the shuffle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from .tables import read_table

# Group numbers of the product types in the driver tables.
GROUP_LABELS = {1: "ECONOMY", 2: "LARGE", 3: "MEDIUM", 4: "PROMO", 5: "SMALL", 6: "STANDARD"}

# Region names of the driver tables (the "states" of the
# state calendars).
REGION_NAMES = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]

# Split table (train / validation / test) used by every forecasting query.
SPLITS = [
    ("train", "1990-01-01", "1999-12-31"),
    ("validation", "2000-01-01", "2000-12-31"),
    ("test", "2001-01-01", "2099-12-31"),
]
TRAIN_END = "1999-12-31"
VALID_START, VALID_END = "2000-01-01", "2000-12-31"
TEST_START = "2001-01-01"


def group_number(type_col: Column) -> Column:
    """Number of a product type by its first word; unknown types give null."""
    first = F.split(type_col, " ").getItem(0)
    m = F.create_map(*[x for k, v in GROUP_LABELS.items() for x in (F.lit(v), F.lit(k))])
    return F.element_at(m, first)


def group_label(grp: Column, default: str = "Unknown") -> Column:
    """group number to label, ``default`` when unknown."""
    m = F.create_map(*[x for k, v in GROUP_LABELS.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(F.try_element_at(m, grp), F.lit(default))


def sales_panel(spark: SparkSession, sf_dir: str, first: str | None = None, last: str | None = None,
                groups: list[int] | None = None) -> DataFrame:
    """``(day date, grp int, units double, lines long)``, one row per day and
    group with at least one line (sparse).

    ``first`` and ``last`` (days, inclusive) become range predicates on
    ``l_shipdate`` in the fact scan, ``groups`` prefix predicates on ``p_type``
    in the part scan, so a query over one year or one group reads and joins
    only that.
    """
    li = read_table(spark, sf_dir, "lineitem", ["l_partkey", "l_shipdate", "l_quantity"])
    pt = read_table(spark, sf_dir, "part", ["p_partkey", "p_type"])
    kind = li.schema["l_shipdate"].dataType          # a cast of the column would keep the filter from the scan
    if first:
        li = li.where(F.col("l_shipdate") >= F.lit(first).cast(kind))
    if last:
        li = li.where(F.col("l_shipdate") < F.date_add(F.lit(last).cast("date"), 1).cast(kind))
    if groups:
        labels = [F.col("p_type").startswith(GROUP_LABELS[g] + " ") | (F.col("p_type") == GROUP_LABELS[g]) for g in groups]
        pt = pt.where(reduce(lambda a, b: a | b, labels))
    pt = pt.select("p_partkey", group_number(F.col("p_type")).alias("grp"))
    return (li.join(pt, li.l_partkey == pt.p_partkey)
            .groupBy(F.to_date("l_shipdate").alias("day"), "grp")
            .agg(F.sum("l_quantity").alias("units"), F.count(F.lit(1)).alias("lines")))


def panel_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(day)``: the first and the last day of the panel, two rows.

    Every line has a part, so the fact table's own dates bound the panel and
    no join is needed for what depends on its span only (years, calendars).
    """
    li = read_table(spark, sf_dir, "lineitem", ["l_shipdate"])
    ends = li.agg(F.min("l_shipdate").alias("lo"), F.max("l_shipdate").alias("hi"))
    return ends.select(F.explode(F.array(F.to_date("lo"), F.to_date("hi"))).alias("day"))


def panel_bounds(spark: SparkSession, sf_dir: str) -> tuple[Column, Column]:
    """First and last day of the panel as scalar subqueries."""
    days = panel_days(spark, sf_dir)
    return days.select(F.min("day")).scalar(), days.select(F.max("day")).scalar()


def panel_table(spark: SparkSession, sf_dir: str, first: str | None = None, last: str | None = None,
                groups: list[int] | None = None) -> DataFrame:
    """The sales panel, built once and checkpointed to the shared folder.

    Every later step (calendar bounds, scalar subqueries, size checks, fit
    and score) reads this small table (days x groups rows) instead of
    re-running the fact join; the checkpoint also cuts the lineage, so a
    lost executor never recomputes the fact join.
    """
    return materialize(sales_panel(spark, sf_dir, first, last, groups))


def daily_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``daily_measures``, checkpointed like ``panel_table``."""
    return materialize(daily_measures(spark, sf_dir))


def priority_code(c: Column) -> Column:
    return F.substring(c, 1, 1).try_cast("int")


def daily_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily exogenous table from ``orders`` (one row per order day).

    * ``temp``: mean order value in units of 10,000, minus 10 (a
      temperature-like scale); cents are summed as integers so the value is
      exact and engine independent.
    * ``wind``: spread of the day's order values, in units of 100,000.
    * ``cloud``: 0-8, eighths of orders with priority 1 or 2.
    * ``code``: the most urgent priority number of the day.
    """
    o = read_table(spark, sf_dir, "orders", ["o_orderdate", "o_totalprice", "o_orderpriority"])
    code = priority_code(F.col("o_orderpriority"))
    cents = F.floor(F.col("o_totalprice") * 100 + 0.5).cast("long")
    g = o.groupBy(F.to_date("o_orderdate").alias("day")).agg(
        F.count(F.lit(1)).alias("n_orders"),
        F.sum(cents).alias("cents"), (F.max(cents) - F.min(cents)).alias("spread"),
        F.sum(F.when(code <= 2, 1).otherwise(0)).alias("n_high"),
        F.min(code).alias("code"),
    )
    return g.select(
        "day", "n_orders",
        (F.col("cents") / F.col("n_orders") / F.lit(1_000_000.0) - F.lit(10.0)).alias("temp"),
        (F.col("spread") / F.lit(10_000_000.0)).alias("wind"),
        F.floor(F.col("n_high") * 8 / F.col("n_orders")).cast("int").alias("cloud"),
        "code",
    )


def code_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(prio_code int, description string)`` from the order priorities."""
    o = read_table(spark, sf_dir, "orders", ["o_orderpriority"])
    return (o.select(priority_code(F.col("o_orderpriority")).alias("prio_code"),
                     F.substring("o_orderpriority", 3, 100).alias("description"))
            .distinct())


def packed_id(day: Column, grp: Column) -> Column:
    """``yyMMdd`` followed by the group digit, e.g. 2018-08-01 group 1
    -> 1808011."""
    return F.date_format(day, "yyMMdd").cast("long") * 10 + grp.cast("long")


def id_day(id_: Column) -> Column:
    """Day of a packed id; two-digit years follow the POSIX ``%y`` rule
    (69-99 -> 19xx, 00-68 -> 20xx)."""
    s = F.lpad(id_.cast("string"), 7, "0")
    yy = F.substring(s, 1, 2).cast("int")
    year = F.when(yy >= 69, yy + 1900).otherwise(yy + 2000)
    return F.make_date(year, F.substring(s, 3, 2).cast("int"), F.substring(s, 5, 2).cast("int"))


def id_group(id_: Column) -> Column:
    """Group digit of a packed id."""
    return (id_ % 10).cast("int")


def split_label(day: Column) -> Column:
    """Split name of a day by the SPLITS table."""
    expr = None
    for name, lo, hi in SPLITS:
        cond = day.between(F.lit(lo).cast("date"), F.lit(hi).cast("date"))
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr
