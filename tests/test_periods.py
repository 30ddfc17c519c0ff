"""Hand-computed cases of contract periods, rates that are missing, and losses by analysis."""

import random
from datetime import date as D
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from inuring.functions import terms
from inuring.operators import audit, cessions, conditional, layering, metrics, yelt
from inuring.plans import engine
from inuring.sources import sinks
from inuring.sources.tables import Tables


# --- portfolios -----------------------------------------------------------------------------------------------------
def test_years_of_portfolio_types(spark):
    """Types 0 to 4, layers of the year before the last, the last, this and the next; as of 2024-03-31."""
    rows = [(k, y, D(2024 + y, 2, 28)) for k in range(5) for y in (-2, -1, 0, 1)]
    df = spark.createDataFrame(rows, "kind int, year int, inception date").withColumn("as_of", F.lit(D(2024, 3, 31)))
    out = {(r.kind, r.year): (r.inception.year, r.expiration) for r in cessions.portfolio_year(df, "kind", "as_of", "inception").collect()}
    year = {
        (0, -2): 2022, (0, -1): 2023, (0, 0): 2024, (0, 1): 2025,
        (1, -2): 2023, (1, -1): 2024, (1, 0): 2025, (1, 1): 2026,
        (2, -1): 2024, (2, 0): 2024,
        (3, -1): 2025, (3, 0): 2025,
    }
    assert out == {k: (y, D(y + 1, 2, 27)) for k, y in year.items()}


def test_leap_day_inception(spark):
    df = spark.createDataFrame([(1, D(2024, 2, 29), D(2024, 1, 1))], "kind int, inception date, as_of date")
    r = cessions.portfolio_year(df, "kind", "as_of", "inception").first()
    assert (r.inception, r.expiration) == (D(2025, 2, 28), D(2026, 2, 27))


# --- missing rates --------------------------------------------------------------------------------------------------
def priced(spark, missing, kept=None):
    net = spark.createDataFrame([(k, 1, 7, D(2024, 1, 1), D(2024, 12, 31), 0.5, 0.5) for k in (1, 2, 9)], "layer_id int, level int, retro_program_id int, start date, end date, gross double, net double")
    net = net.withColumns({c: F.col(c).cast(terms.SHARE) for c in ("gross", "net")})
    layer = "layer_id int, submission_id int, placement double, premium double, limit_basis int, agg_limit double, risk_limit double, occ_limit double, signed_share double, estimated_share double, inception date, expiration date, status int"
    layers = spark.createDataFrame([(k, 1, 1.0, 100.0, 0, 1.0, 1.0, 10.0, 1.0, 1.0, D(2024, 1, 1), D(2024, 12, 31), 10) for k in (1, 2, 3)], layer)
    submissions = spark.createDataFrame([(1, 1)], "submission_id int, tran_type int")
    rates = spark.createDataFrame([(1, 2.0, "USD EUR 2024-01-01"), (2, None, "USD JPY 2024-02-29"), (3, None, "USD CHF 2024-01-01")], "layer_id int, fx double, asked string")
    placements = spark.createDataFrame([(1, 7, 0.25)], "layer_id int, retro_program_id int, placement double")
    return metrics.layer_metrics(net, layers, submissions, rates, placements, missing, kept)


def test_a_missing_rate_fails_and_is_named(spark):
    with pytest.raises(Exception, match="rates: nothing for USD JPY 2024-02-29"):
        priced(spark, audit.FAIL).collect()


@pytest.mark.parametrize("missing,layers", [(audit.DROP, {1: 200.0}), (audit.DEFAULT, {1: 200.0, 2: 100.0})])
def test_misses_are_counted_in_the_pass(spark, missing, layers):
    kept = audit.Audit()
    rows = priced(spark, missing, kept).collect()
    assert {r.layer_id: float(r.deposit_premium) for r in rows} == layers
    assert {r.layer_id: r.retro_placement for r in rows} == {k: 0.25 if k == 1 else 1.0 for k in layers}
    report = kept.report()
    assert report["layers of net cessions"] == {"rows": 3, "misses": 1, "first": "9"}
    assert report["rates"] == {"rows": 2, "misses": 1, "first": "USD JPY 2024-02-29"}
    assert report["placements"] == {"rows": len(layers), "misses": len(layers) - 1, "first": None if len(layers) == 1 else "2 7"}


def test_metrics_fail_by_default(spark, sf_dir):
    """The fixtures' rates without one currency."""
    whole = Tables(spark, sf_dir)
    short = Tables(spark, reader=lambda name: whole.fx_rate.where("currency <> 'JPY'") if name == "fx_rate" else getattr(whole, name))
    with pytest.raises(Exception, match="rates: nothing for USD JPY"):
        engine.by_layer(short).collect()
    assert engine.by_layer(whole).where("deposit_premium IS NULL").isEmpty()


@pytest.mark.parametrize("argument", [{"reset_type": terms.LOD}, {"use_bound": False}, {"base": "EUR"}, {"programs": [3, 5]}])
def test_arguments_of_the_metrics(spark, sf_dir, argument):
    """Each argument changes what it is to change: periods, amounts by the rates, programs."""
    t = Tables(spark, sf_dir)
    plain = {(r.layer_id, r.retro_program_id, r.start, r.end): r for r in engine.by_layer(t).collect()}
    other = {(r.layer_id, r.retro_program_id, r.start, r.end): r for r in engine.by_layer(t, **argument).collect()}
    assert other
    if "programs" in argument:
        assert other == {k: r for k, r in plain.items() if k[1] in argument["programs"]}
    elif "reset_type" in argument:
        assert set(other) != set(plain) and {k[:2] for k in plain} <= {k[:2] for k in other}
    else:
        assert set(other) == set(plain)
        factor = {}
        for k, r in plain.items():
            if r.deposit_premium:
                factor.setdefault(k[0], set()).add(round(float(other[k].deposit_premium / r.deposit_premium), 6))
        assert all(len(f) == 1 for f in factor.values()) and any(f != {1.0} for f in factor.values())


# --- conditional losses ---------------------------------------------------------------------------------------------
def date_of(day, start):
    d = D(start.year, 1, 1) + timedelta(day - 1)
    return d if d >= start else D(start.year + 1, 1, 1) + timedelta(day - 1)


def test_dates_of_days_in_a_period(spark):
    """By walking the calendar: wrapping periods, one that ends in July, whole years, leap years."""
    periods = [(D(1997, 10, 1), D(1998, 9, 30)), (D(1997, 6, 30), D(1997, 7, 15)), (D(1996, 1, 1), D(1996, 12, 31)), (D(1995, 12, 31), D(1996, 12, 30)), (D(1997, 7, 1), D(1997, 7, 1))]
    df = spark.createDataFrame([(k, d, s, e) for k, (s, e) in enumerate(periods) for d in range(1, 366)], "k int, day int, s date, e date")
    out = {(r.k, r.day): r.event_date for r in conditional.in_force(df, "s", "e").collect()}
    for k, (s, e) in enumerate(periods):
        for day in range(1, 366):
            walk = s
            while (walk - D(walk.year, 1, 1)).days + 1 != day:
                walk += timedelta(1)
            assert out.get((k, day)) == (walk if walk <= e else None), (k, day)
    assert sum(1 for k, _ in out if k == 0) == 365 and sum(1 for k, _ in out if k == 1) == 16


def test_aggregate_runs_from_the_inception(spark):
    """A layer from October takes its October first: retention 10 and limit 25 fall on the dates, not on the days."""
    rows = [(1, 5, 300, 12.0), (1, 5, 20, 9.0), (1, 5, 200, 30.0)]
    df = spark.createDataFrame(rows, "layer_id int, year int, day int, occ double").withColumns({"s": F.lit(D(1997, 10, 1)), "e": F.lit(D(1998, 9, 30)), "ret": F.lit(10.0), "lim": F.lit(25.0)})
    met = conditional.in_force(df, "s", "e")
    out = {r.day: r.layer_loss for r in layering.aggregate_losses(met, ["layer_id", "year"], ["event_date"], "occ", "ret", "lim").collect()}
    assert out == {300: 2.0, 20: 9.0, 200: 14.0}


class Fixed:
    """Domain tables made of rows."""

    def __init__(self, spark, **tables):
        for name, (rows, schema) in tables.items():
            setattr(self, name, spark.createDataFrame(rows, schema))


def contract_tables(spark, rnd, layers):
    loads = ", ".join(f"{k}_{p} double" for k in ("peril", "growth", "lae", "social", "cedent") for p in ("eq", "ws", "cs", "wt", "fl", "wf"))
    analysis = "loss_analysis_id int, layer_id int, loss_view int, row_version long, own_gu_analysis_id int, inflation double, " + loads
    no_load = [0.0] * 31
    events = [(10 + k, y, rnd.randint(1, 365), rnd.choice([1, 3]), e, float(rnd.randint(1, 60))) for k in layers for y in range(3) for e in range(25)]
    own = [(100 * v + k, 1, k, y, rnd.randint(1, 365), 14 if e % 2 else 3, 500 + e, 0.1) for k in layers for v in (0, 1) for y in range(3) for e in range(4)]
    return Fixed(
        spark,
        layer=([(k, 1, 10, 0, 1000.0, 40.0, 1000.0, 0.0, 5.0, 0.0, s, e) for k, (s, e) in layers.items()], "layer_id int, submission_id int, status int, limit_basis int, agg_limit double, occ_limit double, risk_limit double, agg_retention double, occ_retention double, risk_retention double, inception date, expiration date"),
        qtd=([(3, 1, 10.0), (3, 2, 99.0)], "layer_id int, rc int, loss_ult double"),
        layer_loss_analysis=([(100 * v + k, k, 1, v, 10 + k, *no_load) for k in layers for v in (0, 1)], analysis),
        gu_yelt_entry=(events, "gu_analysis_id int, year int, day int, peril_id int, event_id int, loss double"),
        submission_gu_analysis=([], "gu_analysis_id int, submission_id int, fx_rate double"),
        px_section=([], "layer_id int, px_layer_id int"),
        layer_analysis_yelt=(own, "loss_analysis_id int, row_version long, layer_id int, year int, day int, peril_id int, event_id int, loss_pct double"),
    ), events, own


@pytest.mark.parametrize("eroded", [True, False])
def test_conditional_run_by_date(spark, eroded):
    """A wrapping layer, one that ends in July, one whose limit the recorded losses use up, one that has ended, one on its own table."""
    layers = {1: (D(1996, 10, 1), D(1997, 9, 30)), 2: (D(1996, 8, 1), D(1997, 7, 31)), 3: (D(1997, 1, 1), D(1997, 12, 31)), 4: (D(1996, 1, 1), D(1996, 12, 31)), 5: (D(1997, 9, 1), D(1998, 8, 31))}
    t, events, own = contract_tables(spark, random.Random(3), layers)
    run = conditional.conditional_run(t, "1997-06-30", eroded, (1, 2), spark.createDataFrame([(5,)], "layer_id int"))
    expected = {}
    for k, (inception, end) in layers.items():
        start = max(inception, D(1997, 6, 30)) if eroded else inception
        limit = 0.0 if eroded and k == 3 else 1000.0
        if k == 5:
            occ = [(y, day, p, e, pct * 40.0) for a, _, i, y, day, p, e, pct in own if a == 105 and i == 5]
        else:
            occ = [(y, day, p, e, min(max(x - 5.0, 0.0), 40.0)) for g, y, day, p, e, x in events if g == 10 + k]
            occ += [(y, day, p, e, pct * 40.0) for a, _, i, y, day, p, e, pct in own if a == 100 + k and p == 14]
        run_of = {}
        for y, day, p, e, x in sorted(occ, key=lambda r: (date_of(r[1], start), r[2], r[3])):
            at = date_of(day, start)
            if start <= end and at <= end:
                before = run_of.get(y, 0.0)
                run_of[y] = before + x
                step = min(before + x, limit) - min(before, limit)
                if step > 0:
                    expected[k, y, day, p, e] = (at, round(step, 6))
    have = {(r.layer_id, r.year, r.day, r.peril_id, r.event_id): (r.event_date, round(float(r.layer_loss), 6)) for r in run.losses.collect()}
    assert have == expected and all(r.loss_analysis_id == 100 + r.layer_id and r.loss_view == 1 for r in run.losses.collect())
    assert len({k[0] for k in have}) == (3 if eroded else 5)
    log = sorted((r.loss_view, r.layer_id, r.place, r.level, r.message) for r in run.log.collect())
    assert [x for x in log if x[0] == 2] == [(2, k, 1, "Warning", "no analysis; status 10; " + ("recorded loss 1000.00" if k == 3 else "no loss recorded")) for k in layers]
    assert [x for x in log if x[2] == 2] == [(1, k, 2, "Information", "layer losses taken for perils 14") for k in (1, 2, 3, 4)]
    assert [x for x in log if x[2] == 3] == ([(1, 4, 3, "Warning", "no period in force from 1997-06-30 to 1996-12-31")] if eroded else [])
    assert [x for x in log if x[2] == 4] == ([(1, 3, 4, "Warning", "limit exhausted")] if eroded else [])
    assert {x[1] for x in log if x[2] == 5} == ({1, 2, 5} if eroded else set(layers))


# --- losses by analysis ---------------------------------------------------------------------------------------------
def test_only_the_newest_analysis_counts(spark, tmp_path):
    """Two analyses of a layer and one of another; the store opens the slices of the chosen ones."""
    rows = [(a, 1, 1 + a // 10, 1, d, 3, d, 0.1 * a) for a in (1, 2, 11) for d in (5, 100, 200)]
    entries = spark.createDataFrame(rows, "loss_analysis_id int, row_version long, layer_id int, year int, day int, peril_id int, event_id int, loss_pct double")
    analyses = spark.createDataFrame([(1, 1, 1, 1), (2, 1, 1, 2), (11, 2, 1, 1), (12, 2, 3, 1)], "loss_analysis_id int, layer_id int, loss_view int, row_version long")
    chosen = yelt.latest_analyses(analyses).select("layer_id", "loss_view", "loss_analysis_id")
    out = yelt.analysis_entries(entries, chosen)
    assert sorted((r.layer_id, r.loss_view, r.loss_analysis_id, r.day) for r in out.collect()) == [(k, 1, a, d) for k, a in ((1, 2), (2, 11)) for d in (5, 100, 200)]

    sinks.write_analyses(entries, str(tmp_path / "store"), slices=8)
    wanted = chosen.where("layer_id = 2 AND loss_view = 1").select("loss_analysis_id", F.lit(1).cast("long").alias("row_version"))
    read = sinks.read_analyses(spark, str(tmp_path / "store"), wanted)
    assert "dynamicpruning" in read._jdf.queryExecution().toString().lower()
    assert sorted((r.loss_analysis_id, r.day) for r in read.collect()) == [(11, 5), (11, 100), (11, 200)]


def test_losses_on_the_days_of_a_program(spark):
    """A program from November to February covers two ranges of days; one of a whole year all of them."""
    entries = spark.createDataFrame([(1, 1, d, 3, d, 1.0) for d in (1, 59, 60, 304, 305, 365)], "layer_id int, year int, day int, peril_id int, event_id int, loss_pct double")
    periods = spark.createDataFrame([(1, 7, 0.5, D(2023, 11, 1), D(2024, 2, 28)), (1, 8, 0.25, D(2023, 1, 1), D(2023, 12, 31))], "layer_id int, retro_program_id int, cession double, start date, end date")
    out = yelt.program_losses(entries, periods, [])
    have = sorted((r.retro_program_id, r.day, r.loss) for r in out.collect())
    assert have == [(7, d, 0.5) for d in (1, 59, 305, 365)] + [(8, d, 0.25) for d in (1, 59, 60, 304, 305, 365)]
