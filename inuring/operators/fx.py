"""Currency conversion as of a date, direct or by a common base.

The reference date is the latest date in the whole table that is not after the one asked for, whatever pairs it has. Dates
of the table are sorted once; requested dates are matched by a window over both, not by a range join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def closest_dates(asked: DataFrame, dates: DataFrame) -> DataFrame:
    """(asked, fx_date) for each distinct date asked; fx_date is null before the first date. Both sides are as small as the
    calendar, so one window over them is too."""
    both = dates.select(F.col("fx_date").alias("at"), F.col("fx_date")).union(asked.select(F.col("asked").alias("at"), F.lit(None).cast("date")))
    both = both.groupBy("at").agg(F.max("fx_date").alias("fx_date"))
    latest = F.last("fx_date", ignorenulls=True).over(Window.orderBy("at").rowsBetween(Window.unboundedPreceding, 0))
    return both.select(F.col("at").alias("asked"), latest.alias("fx_date"))


def rates_as_of(requests: DataFrame, fx: DataFrame, date: str, base: str, currency: str, name: str = "rate", fail: bool = False) -> DataFrame:
    """``requests`` with the rate from base to currency: 1 for the same, the direct rate, else the ratio of the rates in the
    smallest other base that quotes both that day, else null, or a failure when it runs with ``fail``."""
    asked = requests.select(F.col(date).alias("asked")).where(F.col(date).isNotNull()).distinct()
    found = closest_dates(asked, fx.select("fx_date").distinct())
    direct = fx.select(F.col("fx_date").alias("d1"), F.col("base_currency").alias("b1"), F.col("currency").alias("c1"), F.col("rate").alias("direct"))
    x, y = fx.alias("x"), fx.alias("y")
    cross = x.join(y, (F.col("x.fx_date") == F.col("y.fx_date")) & (F.col("x.base_currency") == F.col("y.base_currency"))).groupBy(F.col("x.fx_date").alias("d2"), F.col("x.currency").alias("b2"), F.col("y.currency").alias("c2"))
    cross = cross.agg(F.min_by(F.col("y.rate") / F.col("x.rate"), F.col("x.base_currency")).alias("crossed"))
    out = requests.join(found.withColumnsRenamed({"asked": "asked_", "fx_date": "fx_date_"}), F.col(date) == F.col("asked_"), "left")
    out = out.join(direct, (F.col("fx_date_") == F.col("d1")) & (F.col(base) == F.col("b1")) & (F.col(currency) == F.col("c1")), "left")
    out = out.join(cross, (F.col("fx_date_") == F.col("d2")) & (F.col(base) == F.col("b2")) & (F.col(currency) == F.col("c2")), "left")
    rate = F.when(F.col(base) == F.col(currency), 1.0).otherwise(F.coalesce("direct", "crossed"))
    if fail:
        rate = F.coalesce(rate, F.raise_error(F.concat_ws(" ", F.lit("no rate for"), base, currency, F.col(date).cast("string"))).cast("double"))
    return out.withColumn(name, rate).drop("asked_", "fx_date_", "d1", "b1", "c1", "d2", "b2", "c2", "direct", "crossed")


def layer_rates(layers: DataFrame, submissions: DataFrame, fx: DataFrame, use_bound: bool, current: str, base: str, bound_status: int) -> DataFrame:
    """(layer_id, fx, asked): 1 if the submission is in the base currency; with ``use_bound`` the bound layer's own rate, or the
    submission's where the layer isn't bound, times the base rate of that date; else the current rate. ``asked`` names the
    currencies and the date of the rate; where there is none, ``fx`` is null and whoever uses it decides."""
    own = submissions.select("submission_id", "base_currency", "currency", F.col("fx_rate").alias("s_rate"), F.col("fx_date").alias("s_date"))
    both = layers.join(own, "submission_id")
    unbound = (F.col("status") != bound_status) | F.col("bound_fx_date").isNull() | F.col("bound_fx_rate").isNull()
    dated = F.when(unbound, F.col("s_date")).otherwise(F.col("bound_fx_date"))
    both = both.withColumns({"wanted": F.lit(base), "at": dated, "own": F.when(unbound, F.col("s_rate")).otherwise(F.col("bound_fx_rate")), "now": F.to_date(F.lit(current))})
    date, to = ("at", "base_currency") if use_bound else ("now", "currency")
    priced = rates_as_of(both, fx, date, "wanted", to, "inner_rate")
    rate = F.col("inner_rate") * F.col("own") if use_bound else F.col("inner_rate")
    asked = F.concat_ws(" ", "wanted", to, F.col(date).cast("string"))
    return priced.select("layer_id", F.when(F.col("currency") == base, 1.0).otherwise(rate).alias("fx"), asked.alias("asked"))
