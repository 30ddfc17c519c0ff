"""Closed date intervals: overlap, elementary intervals, and net cessions through inuring levels.

Every join keeps its equality key (layer, program), so ranges are compared within a key only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inuring.functions.terms import LOD, RAD, SHARE, times
from inuring.sources.shared import cut


def left_of(df: DataFrame, s: str, e: str, other_s: str) -> DataFrame:
    """The part of [s, e] before the other interval; rows without one are dropped."""
    return df.withColumns({"start": F.col(s), "end": F.least(F.col(e), F.date_sub(F.col(other_s), 1))}).where(F.col("start") <= F.col("end"))


def right_of(df: DataFrame, s: str, e: str, other_e: str) -> DataFrame:
    return df.withColumns({"start": F.greatest(F.col(s), F.date_add(F.col(other_e), 1)), "end": F.col(e)}).where(F.col("start") <= F.col("end"))


def overlap(df: DataFrame, s: str, e: str, other_s: str, other_e: str) -> DataFrame:
    return df.withColumns({"start": F.greatest(s, other_s), "end": F.least(e, other_e)}).where(F.col("start") <= F.col("end"))


def layer_overlap(df: DataFrame, kind: Column) -> DataFrame:
    """``start``/``end`` of layer and program periods: the overlap for losses occurring; the whole layer period for risks
    attaching, if the layer incepts inside the program's period."""
    attached = (F.col("l_inception") >= F.col("r_inception")) & (F.col("l_inception") <= F.col("r_expiration"))
    start = F.when(kind == LOD, F.greatest("l_inception", "r_inception")).otherwise(F.col("l_inception"))
    end = F.when(kind == LOD, F.least("l_expiration", "r_expiration")).otherwise(F.col("l_expiration"))
    return df.withColumns({"start": start, "end": end}).where(((kind == LOD) & (F.col("start") <= F.col("end"))) | ((kind == RAD) & attached))


def elementary_intervals(df: DataFrame, key: list[str], s: str, e: str, value: str) -> DataFrame:
    """(key, start, end, value): the pieces between all bounds of a key with the sum on each; pieces of sum 0 are dropped.

    One sweep: changes by date are summed up before the running sum, so nothing is multiplied.
    """
    moves = changes(df, s, e, {value: F.col(value)}, key).groupBy(*key, "at").agg(F.sum(value).alias("change"))
    w = Window.partitionBy(*key).orderBy("at")
    pieces = moves.select(*key, F.col("at").alias("start"), F.date_sub(F.lead("at").over(w), 1).alias("end"), F.round(F.sum("change").over(w), 9).alias("value"))
    return pieces.where((F.col("end").isNotNull()) & (F.col("value") != 0))


def changes(df: DataFrame, s: str, e: str, values: dict[str, Column], keep: list[str], once: list[str] = ()) -> DataFrame:
    """(keep, at, open, values, once): two rows for each closed period, one that adds the values at its start and one that
    takes them away after its end; the columns ``once`` count at the start only."""
    up = F.struct(F.col(s).alias("at"), F.lit(1).alias("open"), *[v.alias(k) for k, v in values.items()], *[F.col(o) for o in once])
    down = F.struct(F.date_add(F.col(e), 1).alias("at"), F.lit(-1).alias("open"), *[(-v).alias(k) for k, v in values.items()], *[F.lit(None).alias(o) for o in once])
    return df.select(*keep, F.explode(F.array(up, down)).alias("move")).select(*keep, "move.*")


def net_cessions(c: DataFrame, unit: str, program: list[str]) -> DataFrame:
    """Net cession of each piece of each program's period: gross x product over lower levels of (1 - their gross sum).

    ``c`` has ``unit`` (the layer), ``level``, the program columns, start, end, gross. A program's period is cut where a
    program of a lower level of the unit begins or has just ended. Shares are decimals, so sums are exact and roundings are
    half up.

    Gross cessions are summed up by unit, level and date first; one running sum over a unit's dates gives all level sums, and
    their product the share that is left to each level between two dates. Programs then meet the dates of their unit and
    level. So nothing is gathered, and the work on a layer grows with its programs and dates, not with their pairs. Dates are dealt
    by unit once, before they are summed, and programs to where their unit is.
    """
    c = cut(c.withColumn("gross", F.col("gross").cast(SHARE)))  # it is read several times
    levels = sorted(r.level for r in c.select("level").distinct().collect())  # as many as the data model has
    tasks = int(c.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # by hand, as the pieces are more than the dates
    moves = changes(c, "start", "end", {"gross": F.col("gross")}, [unit, "level"]).repartition(tasks, unit)
    own = [F.sum(F.when(F.col("level") == q, F.col("gross"))).alias(f"c{q}") for q in levels] + [F.count(F.when(F.col("level") == q, 1)).alias(f"n{q}") for q in levels]
    dates = moves.groupBy(unit, "at").agg(*own)
    w = Window.partitionBy(unit).orderBy("at")
    dates = dates.withColumns({f"s{q}": F.coalesce(F.sum(f"c{q}").over(w), F.lit(0).cast(SHARE)) for q in levels})
    left, seen, cuts = F.lit(1).cast(SHARE), F.lit(0), []
    for q in levels:
        cuts.append(F.when(seen > 0, F.struct(F.lit(q).alias("level"), F.col("at").alias("cut"), left.alias("left"))))
        left, seen = times(left, 1 - F.col(f"s{q}"), kind=SHARE), seen + F.col(f"n{q}")
    if not levels:
        cuts = [F.lit(None).cast(f"struct<level:int,cut:date,left:{SHARE}>")]
    bounds = dates.select(F.col(unit).alias("u"), F.explode(F.array(*cuts)).alias("b")).where("b is not null").select("u", F.col("b.level").alias("l"), "b.cut", "b.left")
    order = Window.partitionBy("u", "l").orderBy("cut")
    bounds = bounds.withColumns({"until": F.date_sub(F.lead("cut").over(order), 1), "first": F.row_number().over(order) == 1})
    own = F.struct("cut", "left", "until")
    before = F.struct(F.lit(None).cast("date").alias("cut"), F.lit(1).cast(SHARE).alias("left"), F.date_sub("cut", 1).alias("until"))
    pieces = bounds.select("u", "l", F.explode(F.when(F.col("first"), F.array(own, before)).otherwise(F.array(own))).alias("p")).select("u", "l", "p.*")
    inside = (F.coalesce(F.col("cut"), F.col("start")) <= F.col("end")) & (F.coalesce(F.col("until"), F.col("end")) >= F.col("start"))
    # the level isn't a key of the join, else pieces would be dealt anew by unit and level
    met = c.join(pieces, (F.col(unit) == F.col("u")) & (F.col("level") - F.col("l") == 0) & inside, "left")
    piece = [F.greatest("start", F.coalesce("cut", "start")).alias("start"), F.least("end", F.coalesce("until", "end")).alias("end")]
    return met.select(unit, "level", *program, *piece, "gross", times(F.col("gross"), F.coalesce("left", F.lit(1).cast(SHARE)), kind=SHARE).alias("net"))


def day_ranges(df: DataFrame, s: str, e: str) -> DataFrame:
    """One or two inclusive day-of-year ranges of each period: [1, 365] from 365 days on, two where it crosses a year's end."""
    first, last = F.least(F.dayofyear(s), F.lit(365)), F.least(F.dayofyear(e), F.lit(365))
    span = lambda a, b: F.struct(F.lit(a).cast("int").alias("a") if isinstance(a, int) else a.cast("int").alias("a"), F.lit(b).cast("int").alias("b") if isinstance(b, int) else b.cast("int").alias("b"))
    ranges = F.when(F.datediff(e, s) + 1 >= 365, F.array(span(1, 365))).when(first > last, F.array(span(1, last), span(first, 365))).otherwise(F.array(span(first, last)))
    return df.withColumn("range", F.explode(ranges)).withColumns({"first_day": F.col("range.a"), "last_day": F.col("range.b")}).drop("range")
