"""Year-event-loss tables: selection of analyses, day ranges, merged keys and event losses of many layers."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from inuring.functions.terms import LOSS_VIEWS, MONEY, MOST_FACTOR, MOST_UNITS, PERILS, SHARE, SHARE_UNIT, remapped_view, times, times_units, units, view_priority
from inuring.operators import intervals
from inuring.sources.shared import cut
from inuring.sources.tables import dealt

KEY = ["day", "year", "peril_id", "event_id"]


def latest_analyses(analyses: DataFrame) -> DataFrame:
    """The analysis of the highest row version of each layer and view: an aggregate, so no window sorts whole groups."""
    own = [c for c in analyses.columns if c not in ("layer_id", "loss_view", "row_version")]
    return analyses.groupBy("layer_id", "loss_view").agg(F.max(F.struct("row_version", *own)).alias("r")).select("layer_id", "loss_view", "r.*")


def projected_analyses(analyses: DataFrame) -> DataFrame:
    """As above after revised views take the place of the views they revise: revised first, then by row version."""
    ranked = analyses.withColumns({"loss_view": remapped_view(F.col("loss_view")), "first": -view_priority(F.col("loss_view"))})
    own = [c for c in ranked.columns if c not in ("layer_id", "loss_view", "first", "row_version")]
    return ranked.groupBy("layer_id", "loss_view").agg(F.max(F.struct("first", "row_version", *own)).alias("r")).select("layer_id", "loss_view", "r.*").drop("first")


def analysis_entries(entries: DataFrame, chosen: DataFrame) -> DataFrame:
    """The entries of the chosen analyses (loss_analysis_id, layer_id and more), with what else ``chosen`` says of each. Both keys
    have to fit, as an analysis may have entries of several layers."""
    rows = entries.drop("row_version", *[c for c in chosen.columns if c not in ("loss_analysis_id", "layer_id") and c in entries.columns])
    return rows.join(chosen, ["loss_analysis_id", "layer_id"])


def selected_views(analyses: DataFrame) -> DataFrame:
    return analyses.where(F.col("loss_view").isin(*LOSS_VIEWS))


def retro_layers(t) -> DataFrame:
    """(layer_id, retro_program_id, row_version): the layers ceded to a program with the highest version of an allocation."""
    met = t.retro_allocation.join(t.retro_investor.select("retro_investor_id", "sp_insurer_id"), "retro_investor_id").join(t.sp_insurer.select("sp_insurer_id", "retro_program_id"), "sp_insurer_id")
    return met.groupBy("layer_id", "retro_program_id").agg(F.max("row_version").alias("row_version"))


def program_periods(t) -> DataFrame:
    """(layer_id, retro_program_id, cession, start, end): the cession of each layer to each program, over the period in which the
    program covers the layer."""
    investors = t.retro_investor.select("retro_investor_id", "sp_insurer_id").join(t.sp_insurer.select("sp_insurer_id", "retro_program_id"), "sp_insurer_id")
    # investors are cut, so that their size is known and allocations stay with their layer to meet them
    met = dealt(t, "retro_allocation", "layer_id").select("layer_id", "retro_investor_id", "cession_gross").join(cut(investors), "retro_investor_id")
    ceded = met.groupBy("layer_id", "retro_program_id").agg(F.sum("cession_gross").alias("cession"))
    ceded = ceded.join(t.layer.select("layer_id", F.col("inception").alias("l_inception"), F.col("expiration").alias("l_expiration")), "layer_id")
    programs = t.retro_program.select("retro_program_id", "retro_program_type", F.col("inception").alias("r_inception"), F.col("expiration").alias("r_expiration"))
    out = intervals.layer_overlap(ceded.join(programs, "retro_program_id"), F.col("retro_program_type"))
    return out.select("layer_id", "retro_program_id", "cession", "start", "end")


def program_losses(entries: DataFrame, periods: DataFrame, by: list[str]) -> DataFrame:
    """(retro_program_id, by, KEY, loss): loss share of each event under each program, of the days on which it covers the layer.

    ``entries`` has the columns ``by``, layer_id, KEY and loss_pct, ``periods`` is that of ``program_periods``. A period is one or two
    ranges of days, and an entry meets the ranges of its layer's programs. It is dealt by its event once, with the programs that cover it
    as a list, and becomes a row for each of them where they are summed: the rows are many times the entries, and a map-side sum would
    hold and spill almost all of them.
    """
    ranges = intervals.day_ranges(periods, "start", "end")
    lists = ranges.groupBy("layer_id").agg(F.collect_list(F.struct("retro_program_id", "cession", "first_day", "last_day")).alias("programs"))
    covering = F.filter("programs", lambda p: F.col("day").between(p["first_day"], p["last_day"]))
    met = entries.join(lists, "layer_id").select(*by, *KEY, "loss_pct", covering.alias("programs"))
    # two lists of plain values take less of a shuffle than one of structs; tasks by hand, as their rows grow when the lists are unfolded
    tasks = 4 * int(entries.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    part = lambda n: F.transform("programs", lambda p: p[n]).alias(n)
    met = met.select(*by, *KEY, "loss_pct", part("retro_program_id"), part("cession")).repartition(tasks, *by, *KEY)
    own = met.select(*by, *KEY, "loss_pct", F.inline(F.arrays_zip("retro_program_id", "cession")))
    return own.groupBy("retro_program_id", *by, *KEY).agg(F.sum(F.col("loss_pct") * F.col("cession")).alias("loss"))


def portfolio_retro_layers(t, mark: int | None = None) -> DataFrame:
    """Layers that portfolios cede to programs; with ``mark`` those of cessions of a higher row version."""
    cessions = t.port_layer_cession if mark is None else t.port_layer_cession.where(F.col("row_version") > mark)
    return cessions.join(t.port_layer, "port_layer_id").select("layer_id", "retro_program_id", "port_layer_id", "portfolio_id").distinct()


def day_partition(yelt: DataFrame, first: int, last: int) -> DataFrame:
    """Entries of the days from first to last, both included."""
    return yelt.where(F.col("day").between(first, last))


def merged_keys(yelt: DataFrame) -> DataFrame:
    return yelt.select(*KEY).distinct()


def event_index(yelt: DataFrame) -> DataFrame:
    """Each distinct key with its place (from 0) in the order of day, year, peril, event: places inside a day and a hundred
    years plus the keys of the slices before, so no task sorts all keys or a whole day."""
    keys = merged_keys(yelt).withColumn("slice", F.floor(F.col("year") / 100).cast("int"))
    before = F.sum("own").over(Window.orderBy("day", "slice").rowsBetween(Window.unboundedPreceding, -1))
    # a row for each day of the year and hundred years: as many whatever the layers
    offsets = keys.groupBy("day", "slice").agg(F.count("*").alias("own")).select("day", "slice", F.coalesce(before, F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy("day", "slice").orderBy("year", "peril_id", "event_id")) - 1
    return keys.withColumn("inside", inside).join(offsets, ["day", "slice"]).select(*KEY, (F.col("inside") + F.col("before")).cast("long").alias("place"))


def event_losses(yelt: DataFrame, cessions: DataFrame) -> DataFrame:
    """Loss share of each event over all layers: sum of loss x cession. ``cessions`` has layer_id and cession."""
    return yelt.join(cessions, "layer_id").groupBy(*KEY).agg(F.sum(F.col("loss_pct") * F.col("cession")).alias("loss"))


def gu_yelt(entries: DataFrame) -> DataFrame:
    return entries.groupBy("gu_analysis_id", "year", "event_id", "peril_id", "day").agg(F.sum("loss").cast("double").alias("loss"))


def peril_loads(analyses: DataFrame) -> DataFrame:
    """(loss_analysis_id, peril_id, load, load_x_lae, lae_load) of the perils that have loads, as decimals: the product of one
    plus each of peril, growth, social, cedent and inflation, with and without that of loss adjustment expenses. Perils
    without a row have loads of 1."""
    kinds = ("peril", "growth", "lae", "social", "cedent")
    # an analysis becomes a row for each peril before anything is multiplied: all perils' products in one row are too long a step to be compiled
    own = [F.struct(F.lit(code).alias("peril_id"), *[F.col(f"{k}_{p}").alias(k) for k in kinds]) for p, code in PERILS.items()]
    rows = analyses.select("loss_analysis_id", "inflation", F.explode(F.array(*own)).alias("p")).select("loss_analysis_id", "inflation", "p.*")
    one = lambda kind: 1 + F.col(kind).cast(SHARE)
    without = times(one("peril"), one("growth"), one("social"), one("cedent"), one("inflation"), kind=SHARE)
    rows = rows.select("loss_analysis_id", "peril_id", without.alias("load_x_lae"), one("lae").cast(SHARE).alias("lae_load"))
    return rows.select("loss_analysis_id", "peril_id", times(F.col("load_x_lae"), F.col("lae_load"), kind=SHARE).alias("load"), "load_x_lae", "lae_load")


#: Rows that a task is given of those that analyses grow to when they meet their entries.
ROWS_A_TASK = 500_000
#: Entries of all ground-up analyses (about 60 bytes each) that each executor can hold; of more, an analysis's are dealt to so many tasks.
BROADCAST_ROWS, SALTS = 1_000_000, 8


def gu_loading(analyses: DataFrame, entries: DataFrame, layers: DataFrame, rates: DataFrame, keep: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """What ``loaded_entries`` takes, both computed once: a row for each analysis and peril of its entries, with ``keep``, its rate, the
    peril's loads and the number of ``entries`` that it meets, and the entries of the ground-up analyses, those of a key summed.
    ``analyses`` has loads and gu_analysis_id, ``rates`` a rate by analysis and submission; loads and rates that are missing are 1."""
    own = analyses.select("loss_analysis_id", "layer_id", "gu_analysis_id", *keep).join(layers.select("layer_id", "submission_id"), "layer_id").join(rates, ["gu_analysis_id", "submission_id"], "left")
    met = gu_yelt(entries.join(analyses.select("gu_analysis_id").distinct(), "gu_analysis_id", "left_semi"))
    met = cut(met.withColumn("loss", F.col("loss").cast(MONEY)))
    own = own.join(met.groupBy("gu_analysis_id", "peril_id").agg(F.count("*").alias("entries")), "gu_analysis_id")
    own = own.join(peril_loads(analyses), ["loss_analysis_id", "peril_id"], "left")
    or_one = lambda c: F.coalesce(F.col(c).cast(SHARE), F.lit(1).cast(SHARE)).alias(c)
    return cut(own.select("loss_analysis_id", "layer_id", "gu_analysis_id", "peril_id", *keep, *[or_one(c) for c in FACTORS], "entries")), met


FACTORS = ("load_x_lae", "fx_rate", "lae_load")


def fit_units(own: DataFrame, entries: DataFrame) -> bool:
    """Whether no loss that comes of what ``gu_loading`` gives is negative or too large for units."""
    bounds = entries.groupBy("gu_analysis_id", "peril_id").agg(F.min("loss").alias("low"), F.max("loss").alias("top"))
    product, fits = units(F.col("top")).cast("double"), F.col("low") >= 0
    for f in FACTORS:
        product, fits = product * F.greatest(F.col(f).cast("double"), F.lit(1.0)), fits & F.col(f).between(0, MOST_FACTOR // SHARE_UNIT)
    return own.join(bounds, ["gu_analysis_id", "peril_id"]).agg(F.coalesce(F.min(fits & (product < MOST_UNITS)), F.lit(True)).alias("fits")).first()["fits"]


def in_units(own: DataFrame, entries: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What ``gu_loading`` gives with factors and losses in units."""
    return own.withColumns({f: units(F.col(f), SHARE_UNIT) for f in FACTORS}), entries.withColumn("loss", units(F.col("loss")))


def entry_tasks(own: DataFrame) -> int:
    """The number of tasks for the entries that the analyses of ``gu_loading`` grow to."""
    rows = own.agg(F.sum("entries").alias("n")).first()["n"] or 0
    return max(1, -(-rows // ROWS_A_TASK))


def loaded_entries(own: DataFrame, entries: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """(loss_analysis_id, layer_id, keep, KEY, loss, loss_with_lae) of what ``gu_loading`` gives, or of some of its analyses. All that an
    analysis has of its own is there, so the step to its entries comes last. Losses are decimals, or units where ``own`` and the entries
    are in units, which takes a tenth of the time. Layers are dealt to as many tasks as their entries ask for:
    an analysis is small and what it grows to is not, so the size of its table says nothing."""
    tasks, few = entry_tasks(own), entries.count() <= BROADCAST_ROWS
    own, key = own.drop("entries"), ["gu_analysis_id", "peril_id"]
    if few:  # not left to Spark: it may broadcast the analyses, and the entries' one file would be one task
        met = own.repartition(tasks, "layer_id").join(F.broadcast(entries), key)
    else:
        own = own.withColumn("dealt", F.pmod(F.xxhash64("layer_id"), F.lit(SALTS)).cast("int"))
        dealt = entries.withColumn("dealt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        met = own.repartition(tasks, *key, "dealt").join(dealt.repartition(tasks, *key, "dealt").hint("merge"), [*key, "dealt"]).drop("dealt")
    product = times_units if entries.schema["loss"].dataType.typeName() == "long" else times
    met = met.withColumn("loss", product(F.col("loss"), F.col("load_x_lae"), F.col("fx_rate")))
    return met.select("loss_analysis_id", "layer_id", *keep, *KEY, "loss", product(F.col("loss"), F.col("lae_load")).alias("loss_with_lae"))


def loaded_gu_losses(analyses: DataFrame, entries: DataFrame, layers: DataFrame, rates: DataFrame) -> DataFrame:
    """(loss_analysis_id, layer_id, KEY, loss, loss_with_lae): ground-up loss x load x rate in the layer's currency, as decimals or,
    where they fit, in units."""
    met = gu_loading(cut(analyses), entries, layers, rates)  # they are read several times
    return loaded_entries(*(in_units(*met) if fit_units(*met) else met))


def year_major(yelt: DataFrame, key: list[str]) -> DataFrame:
    """``yelt`` with ``place`` (from 1) of each entry of a key in the order of year, day, peril and event."""
    return yelt.withColumn("place", F.row_number().over(Window.partitionBy(*key).orderBy("year", "day", "peril_id", "event_id")).cast("long"))


def checked_ranges(ranges: DataFrame, key: list[str]) -> DataFrame:
    """``ranges`` (key, first_day, last_day) with ``place`` in the order of their days, ties by the last day; fails when it runs
    if two of a key overlap."""
    w = Window.partitionBy(*key).orderBy("first_day", "last_day")
    out = ranges.withColumns({"place": F.row_number().over(w).cast("int"), "_before": F.lag("last_day").over(w)})
    apart = F.col("_before").isNull() | (F.col("_before") < F.col("first_day"))
    return out.where(F.when(apart, True).otherwise(F.raise_error(F.lit("day ranges overlap")).cast("boolean"))).drop("_before")


def reconciliation(before: DataFrame, after: DataFrame, every: DataFrame, key: list[str], tolerance: float) -> DataFrame:
    """(key, sum_before, n_before, sum_after, n_after, warn) of each key in ``every``: sums and counts of ``share`` in two tables, and
    whether the sums differ by more than the tolerance."""
    side = lambda df, name: df.groupBy(*key).agg(F.sum("share").cast("double").alias(f"sum_{name}"), F.count("*").alias(f"n_{name}"))
    both = every.select(*key).join(side(before, "before"), key, "left").join(side(after, "after"), key, "left")
    both = both.fillna(0, ["sum_before", "n_before", "sum_after", "n_after"])
    return both.withColumn("warn", F.abs(F.col("sum_before") - F.col("sum_after")) > tolerance)
