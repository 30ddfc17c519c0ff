"""Steps whose work has to grow with their input: what their plans may not do."""

import re

from pyspark.sql import functions as F

from inuring.operators import cessions as c
from inuring.operators import yelt as y
from inuring.sources.tables import Tables


def joins(df):
    return [line for line in df._jdf.queryExecution().optimizedPlan().toString().splitlines() if re.search(r"\bJoin\b", line)]


def test_zones_meet_known_pairs_only(spark, sf_dir):
    t = Tables(spark, sf_dir)
    for df in (c.allocations(t), c.placements_of(t, y.retro_layers(t))):
        zoned = [line for line in joins(df) if "top_up_zone_id" in line]
        assert zoned and all("retro_program_id" in line for line in zoned)


def test_placements_of_pairs_are_those_of_all(spark, sf_dir):
    t = Tables(spark, sf_dir)
    pairs = y.retro_layers(t).select("layer_id", "retro_program_id")
    some, every = c.placements_of(t, pairs), c.placements(t)
    rows = lambda df: sorted(tuple(r) for r in df.select("layer_id", "retro_program_id", "placement").collect())
    assert rows(some) == rows(every.join(pairs, ["layer_id", "retro_program_id"])) != []


def test_the_layers_of_one_zone_are_dealt_to_several_tasks(spark, sf_dir):
    t = Tables(spark, sf_dir, None)
    one = Tables(spark, sf_dir, lambda name: t.layer.withColumn("top_up_zone_id", F.col("layer_id") % 1 + 1) if name == "layer" else getattr(t, name))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = c.placements(one).rdd.mapPartitions(lambda part: [sum(1 for _ in part)]).collect()
        assert sum(n > 0 for n in rows) > 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_loaded_losses_meet_their_entries_last(spark, sf_dir):
    t = Tables(spark, sf_dir)
    newest = y.latest_analyses(t.layer_loss_analysis).withColumn("gu_analysis_id", F.col("own_gu_analysis_id"))
    last = joins(y.loaded_gu_losses(newest, t.gu_yelt_entry, t.layer, t.submission_gu_analysis))[0]
    assert "gu_analysis_id" in last and "submission_id" not in last and "layer_id" not in last


def test_a_layers_entries_stay_with_the_task_that_made_them(spark, sf_dir):
    t = Tables(spark, sf_dir)
    newest = y.latest_analyses(t.layer_loss_analysis).withColumn("gu_analysis_id", F.col("own_gu_analysis_id"))
    rows = y.ROWS_A_TASK
    y.ROWS_A_TASK = 5_000
    try:
        out = y.loaded_gu_losses(newest, t.gu_yelt_entry, t.layer, t.submission_gu_analysis)
        sizes = out.rdd.mapPartitions(lambda part: [sum(1 for _ in part)]).collect()
    finally:
        y.ROWS_A_TASK = rows
    assert len(sizes) == -(-sum(sizes) // 5_000) > 4 and max(sizes) < 15_000
    shuffled = [line for line in out._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange hashpartitioning" in line]
    assert shuffled and all("layer_id" in line for line in shuffled)


def test_layers_are_looked_up_at_their_depth_only(spark):
    from inuring.operators import layering

    seen = []
    every = spark.createDataFrame([(1, 1, 1, 3, 1, 100.0), (2, 1, 1, 3, 1, 10.0), (9, 1, 1, 3, 1, 1.0)], "layer_id int, day int, year int, peril_id int, event_id long, loss double")

    def losses(keep):
        layers = keep(every.select("layer_id").distinct())
        seen.append(sorted(r.layer_id for r in layers.collect()))
        return every.join(layers, "layer_id").withColumn("loss", F.col("loss").cast("decimal(20,8)"))

    sections = spark.createDataFrame([(1, 2)], "layer_id int, px_layer_id int")
    terms = spark.createDataFrame([(1, 20.0, 500.0), (2, 5.0, 80.0), (9, 5.0, 80.0)], "layer_id int, r double, l double")
    terms = terms.select("layer_id", F.col("r").cast("decimal(20,8)").alias("occ_retention"), F.col("l").cast("decimal(20,8)").alias("occ_limit"))
    out = {r.layer_id: float(r.occ) for r in layering.sectioned_losses(losses, sections, terms).collect()}
    assert seen == [[1, 9], [2]] and out == {1: 80.0, 2: 80.0}


def test_dealt_entries_give_what_broadcast_ones_do(spark, sf_dir):
    t = Tables(spark, sf_dir)
    newest = y.latest_analyses(t.layer_loss_analysis).withColumn("gu_analysis_id", F.col("own_gu_analysis_id"))
    own, entries = y.gu_loading(newest, t.gu_yelt_entry, t.layer, t.submission_gu_analysis)
    few = y.BROADCAST_ROWS
    y.BROADCAST_ROWS = 0
    try:
        dealt = y.loaded_entries(own, entries)
    finally:
        y.BROADCAST_ROWS = few
    every = y.loaded_entries(own, entries)
    assert dealt.exceptAll(every).isEmpty() and dealt.count() == every.count() > 0


def test_requests_meet_one_period_and_are_not_sorted(spark):
    day = lambda n: None if n is None else f"1996-01-{n:02d}"
    rows = [(k, day(s), v) for k, s, v in ((1, 5, 1), (1, 9, 2), (1, 9, 3), (1, 20, 4), (2, 7, 5), (3, None, 6), (3, None, 7), (3, 8, 8))]
    asked = [(k, day(at)) for k in (1, 2, 3, 4) for at in (None, 1, 5, 8, 9, 19, 20, 30)] * 2
    cast = lambda c: F.col(c).cast("date").alias(c)
    periods = spark.createDataFrame(rows, "k int, start_date string, v int").select("k", cast("start_date"), "v")
    requests = spark.createDataFrame(asked, "k int, at string").select("k", cast("at"))
    df = c.as_of_periods(requests, periods, ["k"], "at")
    have = sorted((r.k, str(r.at), r.v) for r in df.collect())
    want = set()
    for k, at in asked:
        own = sorted(((s or "", v) for key, s, v in rows if key == k))
        met = [x for x in own if x[0] and at and x[0] <= at]
        if own:
            want.add((k, str(at), (max(met) if met else own[0])[1]))
    assert have == sorted(want)
    assert "SortAggregate" not in df._jdf.queryExecution().executedPlan().toString()


def test_a_depths_own_losses_are_not_shuffled(spark, sf_dir, monkeypatch):
    from inuring.operators import conditional, layering

    plans, cut = [], layering.cut

    def recorded(df):
        if "occ" in df.columns:
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        return cut(df)

    monkeypatch.setattr(layering, "cut", recorded)
    monkeypatch.setattr(y, "ROWS_A_TASK", 1_000)  # several tasks
    run = conditional.conditional_run(Tables(spark, sf_dir), "1997-06-30", True)
    assert len(plans) == 4 and run.losses.count() > 0
    exchanges = [line for plan in plans for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert exchanges and not any("event_id" in line for line in exchanges)


def test_layers_without_a_period_that_feed_none_are_not_loaded(spark, sf_dir, monkeypatch):
    from inuring.operators import conditional

    loaded, loading = [], y.gu_loading

    def recorded(analyses, *rest):
        loaded.append({r.layer_id for r in analyses.select("layer_id").distinct().collect()})
        return loading(analyses, *rest)

    monkeypatch.setattr(y, "gu_loading", recorded)
    t = Tables(spark, sf_dir)
    conditional.conditional_run(t, "1997-06-30", True)
    over = {r.layer_id for r in t.layer.where("expiration < DATE '1997-06-30'").select("layer_id").collect()}
    feeding = {r.layer_id for r in t.px_section.select("layer_id").distinct().collect()}
    assert loaded[0] & over and loaded[0] & over <= feeding


def dealt_before_sums(df, last):
    """Whether the last column of a shuffle's key, by which rows are dealt, is below the first sum of them."""
    lines = df._jdf.queryExecution().optimizedPlan().toString().splitlines()
    sums = [n for n, line in enumerate(lines) if "Aggregate [" in line and f"{last}#" in line.split("]")[0]]
    return bool(sums) and any("RepartitionByExpression" in line and f"{last}#" in line for line in lines[sums[-1] + 1 : sums[-1] + 3])


def test_changes_are_dealt_by_date_before_they_are_summed(spark):
    from inuring.operators import metrics

    rows = spark.createDataFrame([(1, "1996-01-01", "1996-01-09", 2.0), (1, "1996-01-05", "1996-01-20", 3.0)], "k int, s string, e string, v double")
    df = metrics.peak_limits(rows.select("k", F.col("s").cast("date").alias("s"), F.col("e").cast("date").alias("e"), "v"), ["k"], "s", "e", "v")
    assert [tuple(r) for r in df.collect()] == [(1, 5.0)]
    assert dealt_before_sums(df, "at")


def test_program_losses_are_dealt_by_event_before_they_are_summed(spark, sf_dir):
    t = Tables(spark, sf_dir)
    entries = t.layer_yelt.select("layer_id", *y.KEY, "loss_pct")
    df = y.program_losses(entries, y.program_periods(t), [])
    assert df.count() > 0
    assert dealt_before_sums(df.select("retro_program_id", "event_id", "loss"), "event_id")


def test_rules_are_shuffled_by_number(spark, sf_dir):
    from inuring.sources import contracts

    df = contracts.violations(Tables(spark, sf_dir))
    shuffled = [line for line in df._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange hashpartitioning" in line]
    assert any("key#" in line for line in shuffled) and not any("rule#" in line or "table_name#" in line for line in shuffled)


def test_allocations_are_dealt_once(spark, sf_dir):
    t = Tables(spark, sf_dir)
    periods = c.cession_periods(t)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")
    try:
        plan = c.period_gross(c.allocations(t, c.cut(periods)), c.cut(periods))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    big = [line for line in plan.splitlines() if re.search(r"Exchange hashpartitioning\((l_partkey|.*layer_id)", line) and "l_inception" not in line]
    assert "hashpartitioning(l_partkey" in plan and all(re.search(r"hashpartitioning\((l_partkey|layer_id)#\d+, \d+\)", line) for line in big)


def test_what_is_stored_twice_counts_once(spark, sf_dir):
    t = Tables(spark, sf_dir, None)
    doubled = ("retro_allocation", "layer")
    twice = Tables(spark, sf_dir, lambda name: getattr(t, name).union(getattr(t, name)) if name in doubled else getattr(t, name))
    one, two = c.allocations(t), c.allocations(twice)
    assert one.exceptAll(two).isEmpty() and one.count() == two.count() > 0
    for kind in (1, 2):
        one, two = c.cession_view(t, kind), c.cession_view(twice, kind)
        assert one.exceptAll(two).isEmpty() and one.count() == two.count() > 0


def test_pieces_and_their_metrics_stay_with_their_layer(spark, sf_dir):
    from inuring.plans import engine

    plan = engine.by_layer(Tables(spark, sf_dir))._jdf.queryExecution().executedPlan().toString()
    dealt = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line and re.search(r"\b(layer_id|u|l|at|retro_program_id)#", line)]
    # no pieces, dates or allocations are dealt by layer and level, date or program
    assert dealt and not any(re.search(r"\(((layer_id|u)#\d+, (l|level|at|retro_program_id)#|retro_program_id#\d+, layer_id#)", line) for line in dealt)


def test_units_give_what_decimals_do(spark):
    from inuring.functions import terms as x

    rows = [("0.00000001", "0.5"), ("0.00000003", "0.5"), ("899999999.12345678", "9.9999999999"), ("12345678.90123456", "0.0000000001"), ("0", "8999"), ("50.00000001", "1.2345678905")]
    df = spark.createDataFrame(rows, "v string, f string").select(F.col("v").cast(x.MONEY).alias("v"), F.col("f").cast(x.SHARE).alias("f"))
    whole = x.times_units(x.units(F.col("v")), x.units(F.col("f"), x.SHARE_UNIT))
    exact = x.times(F.col("v"), F.col("f"))
    for r in df.select(exact.alias("exact"), x.from_units(whole).alias("whole"), F.round(exact, 6).cast("double").alias("d"), x.units_to_double(whole, 6).alias("w")).collect():
        assert r.exact == r.whole and r.d == r.w


def test_losses_are_loaded_in_units_where_they_fit(spark, sf_dir, monkeypatch):
    from inuring.functions import terms as x

    t = Tables(spark, sf_dir)
    newest = y.latest_analyses(t.layer_loss_analysis).withColumn("gu_analysis_id", F.col("own_gu_analysis_id"))
    load = lambda: y.loaded_gu_losses(newest, t.gu_yelt_entry, t.layer, t.submission_gu_analysis)
    whole = load()
    monkeypatch.setattr(y, "MOST_UNITS", 10)
    exact = load()
    assert dict(whole.dtypes)["loss"] == "bigint" and dict(exact.dtypes)["loss"] == x.MONEY
    as_decimals = whole.withColumns({n: x.from_units(F.col(n)) for n in ("loss", "loss_with_lae")})
    assert as_decimals.exceptAll(exact).isEmpty() and exact.count() == whole.count() > 0


def test_negative_losses_are_not_loaded_in_units(spark):
    own = spark.createDataFrame([(1, 3, 1.0, 1.0, 1.0)], "gu_analysis_id int, peril_id int, load_x_lae double, fx_rate double, lae_load double")
    entries = spark.createDataFrame([(1, 3, -5.0)], "gu_analysis_id int, peril_id int, loss double").withColumn("loss", F.col("loss").cast("decimal(20,8)"))
    assert not y.fit_units(own, entries) and y.fit_units(own, entries.withColumn("loss", -F.col("loss")))


def test_years_begin_anew_in_running_sums_of_units(spark):
    from inuring.operators import layering

    rows = [(1, y_, d, loss) for y_ in (1, 2, 5) for d, loss in ((3, 40), (9, 70), (20, -10), (30, 500))] + [(2, 1, 1, 1000)]
    df = spark.createDataFrame(rows, "layer_id int, year int, day int, loss long").withColumns({"ret": F.lit(50).cast("long"), "lim": F.lit(400).cast("long")})
    args = (["layer_id", "year"], ["day"], "loss", "ret", "lim")
    exact, whole = layering.aggregate_losses(df, *args), layering.aggregate_units(df, *args)
    assert exact.exceptAll(whole.select(exact.columns)).isEmpty() and whole.count() == len(rows)


def test_conditional_runs_in_units_give_what_decimals_do(spark, sf_dir, monkeypatch):
    from inuring.operators import conditional

    t, seen = Tables(spark, sf_dir), []
    own = t.layer.where("limit_basis = 7")
    fit = y.fit_units
    monkeypatch.setattr(y, "fit_units", lambda *a: seen.append(fit(*a)) or seen[-1])
    whole = conditional.conditional_run(t, "1997-06-30", True, by_layer_loss=own)
    monkeypatch.setattr(y, "fit_units", lambda *a: False)
    exact = conditional.conditional_run(t, "1997-06-30", True, by_layer_loss=own)
    names = ["loss_view", "layer_id", *y.KEY, "event_date", "layer_loss", "rounded_loss"]
    cast = lambda df: df.losses.withColumn("layer_loss", F.col("layer_loss").cast("decimal(20,8)")).select(names)
    assert seen == [True] and cast(whole).exceptAll(cast(exact)).isEmpty() and whole.losses.count() == exact.losses.count() > 0


def test_only_keys_that_may_meet_are_summed(spark, sf_dir):
    """Losses that are added to a layer's own may have the key of a section's: such rows are one, all others are not summed."""
    from inuring.operators import conditional

    t = Tables(spark, sf_dir, None)
    one = t.px_section.join(t.layer.where("limit_basis = 7").select(F.col("layer_id").alias("px_layer_id")), "px_layer_id").select("px_layer_id").distinct()
    gu = t.gu_yelt_entry.where("gu_analysis_id < 100").select("year", "day", "peril_id", "event_id").distinct().limit(400)
    analyses = t.layer_loss_analysis.select("loss_analysis_id", "layer_id", "row_version").join(one, F.col("layer_id") == F.col("px_layer_id"))
    more = analyses.crossJoin(gu).selectExpr("loss_analysis_id", "row_version", "layer_id", "year", "day", "peril_id", "event_id", "0.25D loss_pct", "0D rp", "1 loss_type")
    both = t.layer_analysis_yelt.unionByName(more)
    meeting = Tables(spark, sf_dir, lambda name: both if name == "layer_analysis_yelt" else getattr(t, name))
    losses = conditional.conditional_run(meeting, "1997-06-30", False, by_layer_loss=t.layer.where("limit_basis = 7")).losses
    keys = losses.groupBy("loss_view", "layer_id", *y.KEY).agg(F.count("*").alias("n"))
    assert keys.where("n > 1").isEmpty() and not losses.join(one, F.col("layer_id") == F.col("px_layer_id"), "left_semi").isEmpty()


def test_entries_are_dealt_once_with_their_programs(spark, sf_dir):
    t = Tables(spark, sf_dir)
    df = y.program_losses(t.layer_yelt.select("layer_id", *y.KEY, "loss_pct"), y.program_periods(t), [])
    lines = df._jdf.queryExecution().optimizedPlan().toString().splitlines()
    by_event = next(n for n, line in enumerate(lines) if "RepartitionByExpression" in line and "event_id#" in line)
    assert any("Generate inline" in line for line in lines[:by_event])


def test_keys_are_dealt_before_they_are_counted(spark, sf_dir):
    from inuring.sources import contracts

    assert dealt_before_sums(contracts.violations(Tables(spark, sf_dir)), "without")


def test_a_task_goes_through_programs_and_holds_its_layers(spark, sf_dir):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = c.placements(Tables(spark, sf_dir))
        assert re.search(r"ShuffledHashJoin .*BuildLeft", df._jdf.queryExecution().executedPlan().toString())
        rows = df.rdd.mapPartitions(lambda part: [[r.retro_program_id for r in part]]).collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # of a program's rows most follow another one of it
    assert sum(a == b for part in rows for a, b in zip(part, part[1:])) > sum(map(len, rows)) / 2
