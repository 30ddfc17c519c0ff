"""Hand-computed cases and properties of the interval, currency, date and key operators."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from inuring.functions import terms
from inuring.operators import fx, graph, intervals, layering, metrics

D = date


def cessions(spark, rows):
    return spark.createDataFrame(rows, "layer int, level int, p int, start date, end date, gross double")


def test_two_levels(spark):
    c = cessions(spark, [(1, 1, 1, D(2024, 1, 1), D(2024, 6, 30), 0.4), (1, 2, 2, D(2024, 1, 1), D(2024, 12, 31), 0.5)])
    out = {(r.p, r.start, r.end): round(float(r.net), 9) for r in intervals.net_cessions(c, "layer", ["p"]).collect()}
    assert out == {(1, D(2024, 1, 1), D(2024, 6, 30)): 0.4, (2, D(2024, 1, 1), D(2024, 6, 30)): 0.3, (2, D(2024, 7, 1), D(2024, 12, 31)): 0.5}


def test_adjacent_equal_periods_stay_apart(spark):
    c = cessions(spark, [(1, 1, 1, D(2024, 1, 1), D(2024, 3, 31), 0.2), (1, 1, 2, D(2024, 4, 1), D(2024, 6, 30), 0.2), (1, 2, 3, D(2024, 1, 1), D(2024, 6, 30), 0.5)])
    out = sorted((r.start, r.end, round(float(r.net), 9)) for r in intervals.net_cessions(c, "layer", ["p"]).where("p = 3").collect())
    assert out == [(D(2024, 1, 1), D(2024, 3, 31), 0.4), (D(2024, 4, 1), D(2024, 6, 30), 0.4)]


@pytest.mark.parametrize("seed", range(3))
def test_net_cessions_by_day(spark, seed):
    rnd = random.Random(seed)
    start = D(2024, 1, 1)
    rows = []
    for p in range(25):
        a = rnd.randint(0, 50)
        rows.append((p % 3, rnd.randint(1, 4), p, start + timedelta(a), start + timedelta(a + rnd.randint(0, 30)), rnd.randint(1, 30) / 100))
    pieces = intervals.net_cessions(cessions(spark, rows), "layer", ["p"]).collect()
    for layer, level, p, s, e, gross in rows:
        mine = sorted((r.start, r.end, float(r.net)) for r in pieces if r.p == p)
        assert mine[0][0] == s and mine[-1][1] == e
        assert all(a[1] + timedelta(1) == b[0] for a, b in zip(mine, mine[1:]))
        for a, b, net in mine:
            for k in range((b - a).days + 1):
                day, left = a + timedelta(k), 1.0
                for q in range(1, level):
                    left *= 1 - sum(r[5] for r in rows if r[0] == layer and r[1] == q and r[3] <= day <= r[4])
                assert abs(net - gross * left) < 1e-9


def test_elementary_intervals_drop_zero(spark):
    df = spark.createDataFrame([(1, D(2024, 1, 1), D(2024, 1, 10), 0.2), (1, D(2024, 1, 5), D(2024, 1, 20), 0.3), (1, D(2024, 2, 1), D(2024, 2, 2), 0.1)], "k int, s date, e date, v double")
    out = sorted((r.start, r.end, r.value) for r in intervals.elementary_intervals(df, ["k"], "s", "e", "v").collect())
    assert out == [(D(2024, 1, 1), D(2024, 1, 4), 0.2), (D(2024, 1, 5), D(2024, 1, 10), 0.5), (D(2024, 1, 11), D(2024, 1, 20), 0.3), (D(2024, 2, 1), D(2024, 2, 2), 0.1)]


def test_risks_attaching(spark):
    df = spark.createDataFrame([(1, D(2023, 12, 31), D(2024, 12, 30)), (2, D(2024, 12, 31), D(2025, 12, 30))], "id int, l_inception date, l_expiration date")
    df = df.withColumns({"r_inception": F.lit(D(2024, 1, 1)), "r_expiration": F.lit(D(2024, 12, 31))})
    assert [(r.id, r.start, r.end) for r in intervals.layer_overlap(df, F.lit(terms.RAD)).collect()] == [(2, D(2024, 12, 31), D(2025, 12, 30))]


def test_fx_as_of_and_triangulation(spark):
    rates = spark.createDataFrame([(D(2024, 1, 1), "USD", "EUR", 0.9), (D(2024, 1, 1), "USD", "GBP", 0.8), (D(2024, 1, 3), "USD", "GBP", 0.75)], "fx_date date, base_currency string, currency string, rate double")
    asked = spark.createDataFrame([(1, D(2024, 1, 2), "USD", "EUR"), (2, D(2024, 1, 2), "EUR", "GBP"), (3, D(2024, 1, 4), "USD", "EUR"), (4, D(2023, 12, 31), "USD", "EUR"), (5, D(2024, 1, 4), "GBP", "GBP")], "id int, d date, b string, c string")
    out = {r.id: r.rate for r in fx.rates_as_of(asked, rates, "d", "b", "c").collect()}
    assert out[1] == 0.9 and abs(out[2] - 0.8 / 0.9) < 1e-12 and out[3] is None and out[4] is None and out[5] == 1.0


def test_dates(spark):
    df = spark.createDataFrame([(D(2024, 12, 10),), (D(2024, 2, 1),)], "d date").select(terms.accounting_period(F.col("d")), terms.quarter_end(F.col("d")))
    assert [tuple(r) for r in df.collect()] == [(202409, D(2024, 9, 30)), (202312, D(2023, 12, 31))]


def test_day_ranges(spark):
    df = spark.createDataFrame([(1, D(2023, 10, 1), D(2024, 3, 30)), (2, D(2023, 1, 1), D(2023, 12, 31)), (3, D(2023, 2, 1), D(2023, 2, 3))], "id int, s date, e date")
    out = sorted((r.id, r.first_day, r.last_day) for r in intervals.day_ranges(df, "s", "e").collect())
    assert out == [(1, 1, 90), (1, 274, 365), (2, 1, 365), (3, 32, 34)]


def test_keys_round_trip(spark):
    rnd = random.Random(5)
    rows = [(rnd.randint(1, 365), rnd.randint(1, 10000), rnd.randint(0, 63), rnd.randint(1, 8589934591)) for _ in range(500)]
    df = spark.createDataFrame(rows, "day int, year int, peril_id int, event_id long").withColumn("k", terms.day_key(F.col("day"), F.col("year"), F.col("peril_id"), F.col("event_id")))
    for r in df.select("day", "year", "peril_id", "event_id", *[v.alias(f"b_{k}") for k, v in terms.day_key_parts(F.col("k")).items()]).collect():
        assert (r.day, r.year, r.peril_id, r.event_id) == (r.b_day, r.b_year, r.b_peril_id, r.b_event_id)


def test_peak_of_negative_exposures(spark):
    df = spark.createDataFrame([(1, D(2024, 1, 1), D(2024, 1, 31), -5.0), (1, D(2024, 3, 1), D(2024, 3, 31), -7.0)], "k int, s date, e date, v double")
    assert metrics.peak_limits(df, ["k"], "s", "e", "v").first().peak == -5.0


def test_components_and_depth(spark):
    rnd = random.Random(9)
    edges = [(a, a + rnd.randint(1, 4)) for a in range(0, 60) if rnd.random() < 0.6]
    parent = {v: v for e in edges for v in e}

    def find(v):
        return v if parent[v] == v else find(parent[v])

    for a, b in edges:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    df = spark.createDataFrame(edges, "a int, b int")
    assert {r.vertex: r.component for r in graph.connected_components(df, "a", "b").collect()} == {v: find(v) for v in parent}
    depth = {}
    for v in sorted(parent):
        depth[v] = max((depth[a] + 1 for a, b in edges if b == v), default=0)
    assert {r.vertex: r.depth for r in graph.topological_depth(df, "a", "b").collect()} == depth


def test_layering_by_hand(spark):
    df = spark.createDataFrame([(1, k, loss) for k, loss in enumerate([50.0, 80.0, 100.0])], "layer int, at int, loss double").withColumns({"ret": F.lit(60.0), "lim": F.lit(100.0)})
    out = layering.aggregate_losses(df, ["layer"], ["at"], "loss", "ret", "lim").orderBy("at").collect()
    assert [r.layer_loss for r in out] == [0.0, 70.0, 30.0]


def test_missing_rate_fails_on_demand(spark):
    rates = spark.createDataFrame([(D(2024, 1, 1), "USD", "EUR", 0.9)], "fx_date date, base_currency string, currency string, rate double")
    asked = spark.createDataFrame([(D(2024, 1, 2), "USD", "GBP")], "d date, b string, c string")
    assert fx.rates_as_of(asked, rates, "d", "b", "c").first().rate is None
    with pytest.raises(Exception, match="no rate for USD GBP"):
        fx.rates_as_of(asked, rates, "d", "b", "c", fail=True).collect()


def test_halves_are_rounded_up_and_nothing_else(spark):
    """10.004 stays 10.00 and 10.005 becomes 10.01, sums are exact, and a net cession that ends in a half is no matter of its
    last bit."""
    from inuring.plans.engine import exact

    df = spark.createDataFrame([(1, D(2024, 1, 1), D(2024, 12, 31), 10.004), (2, D(2024, 1, 1), D(2024, 12, 31), 10.005)], "p int, s date, e date, v double").withColumn("v", F.col("v").cast(terms.MONEY))
    assert [r.peak for r in exact(metrics.peak_limits(df, ["p"], "s", "e", "v"), "peak", digits=2).orderBy("p").collect()] == [10.0, 10.01]
    c = cessions(spark, [(1, 1, 1, D(2024, 1, 1), D(2024, 1, 31), 0.0005), (1, 2, 2, D(2024, 1, 1), D(2024, 1, 31), 0.0029)])
    out = {r.p: r.net for r in exact(intervals.net_cessions(c, "layer", ["p"]), "net").collect()}
    assert out == {1: 0.0005, 2: 0.0028986}  # 0.00289855


def test_loads_of_all_perils(spark):
    from inuring.operators import yelt
    from inuring.sources.tables import LOADS, PERILS

    columns = {f"{k}_{p}": (i + 1) / 100 for i, (k, p) in enumerate((k, p) for k in LOADS for p in PERILS)}
    df = spark.createDataFrame([(7, *columns.values(), 0.03)], f"loss_analysis_id int, {', '.join(f'{c} double' for c in columns)}, inflation double")
    out = {r.peril_id: r for r in yelt.peril_loads(df).collect()}
    assert set(out) == set(terms.PERILS.values())
    for p, code in terms.PERILS.items():
        without = (1 + columns[f"peril_{p}"]) * (1 + columns[f"growth_{p}"]) * (1 + columns[f"social_{p}"]) * (1 + columns[f"cedent_{p}"]) * 1.03
        assert abs(float(out[code].load_x_lae) - without) < 1e-9 and abs(float(out[code].load) - without * (1 + columns[f"lae_{p}"])) < 1e-9
        assert abs(float(out[code].lae_load) - 1 - columns[f"lae_{p}"]) < 1e-12


def test_overlapping_day_ranges_fail(spark):
    from inuring.operators import yelt

    df = spark.createDataFrame([(1, 50, 60), (1, 1, 49), (2, 5, 9)], "k int, first_day int, last_day int")
    assert sorted((r.k, r.place, r.first_day) for r in yelt.checked_ranges(df, ["k"]).collect()) == [(1, 1, 1), (1, 2, 50), (2, 1, 5)]
    with pytest.raises(Exception, match="overlap"):
        yelt.checked_ranges(df.union(spark.createDataFrame([(1, 60, 70)], df.schema)), ["k"]).collect()


def test_tables_by_configuration(spark, sf_dir, tmp_path):
    from inuring.sources.tables import Tables

    fixtures = Tables(spark, sf_dir)
    for name in ("layer", "retro_allocation"):
        getattr(fixtures, name).limit(20).write.parquet(str(tmp_path / name))
    spark.conf.set("spark.inuring.tables", f"parquet:{tmp_path}")
    try:
        assert Tables(spark).layer.count() == 20 and Tables(spark).retro_allocation.columns == fixtures.retro_allocation.columns
        spark.conf.set("spark.inuring.tables", "catalog:default")
        getattr(fixtures, "layer").limit(5).createOrReplaceTempView("layer_view")
        assert Tables(spark, reader=lambda n: spark.table(f"{n}_view")).layer.count() == 5
        spark.conf.set("spark.inuring.tables", "files:x")
        with pytest.raises(ValueError, match="must begin"):
            Tables(spark)
    finally:
        spark.conf.unset("spark.inuring.tables")


def test_sections_feed_their_layers(spark):
    """1 and 2 are sections of 3, which is one of 4; each layer's own loss counts too."""
    key = "day int, year int, peril_id int, event_id long"
    losses = spark.createDataFrame([(1, 5, 1, 3, 9, 100.0), (2, 5, 1, 3, 9, 50.0), (3, 5, 1, 3, 9, 10.0), (9, 5, 1, 3, 9, 7.0)], f"layer_id int, {key}, loss double").withColumn("loss", F.col("loss").cast(terms.MONEY))
    sections = spark.createDataFrame([(1, 3), (2, 3), (3, 4)], "layer_id int, px_layer_id int")
    limits = spark.createDataFrame([(1, 20.0, 60.0), (2, 0.0, 100.0), (3, 30.0, 70.0), (4, 0.0, 65.0), (9, 0.0, 5.0)], "layer_id int, occ_retention double, occ_limit double").select("layer_id", *[F.col(c).cast(terms.MONEY).alias(c) for c in ("occ_retention", "occ_limit")])
    out = {r.layer_id: float(r.occ) for r in layering.sectioned_losses(losses, sections, limits).collect()}
    assert out == {1: 60.0, 2: 50.0, 3: 70.0, 4: 65.0, 9: 5.0}


SCENARIO = "scenario_id long, event_key long, event_date date, layer_id int, gu_loss double, fx_rate_to_layer_currency double, limit_basis int, premium double, occ_limit double, agg_limit double, risk_limit double, occ_retention double, agg_retention double, risk_retention double"
BANDS = "reinstatement_id int, layer_id int, reinstatement_order int, quantity double, premium_share double, brokerage_percentage double"


def test_scenario_losses_by_hand(spark):
    """Two events of 100 over 20 up to 50, 15 of it retained for the year; the first use of the limit is reinstated, at half the premium."""
    rows = [(1, k, D(2024, 1, k), 1, 100.0, 1.0, 3, 10.0, 50.0, 80.0, 0.0, 20.0, 15.0, 0.0) for k in (1, 2)]
    rows += [(1, 3, D(2024, 1, 1), 2, 100.0, 2.0, 3, 10.0, 50.0, 80.0, 0.0, 20.0, 0.0, 0.0)]
    reinstatements = spark.createDataFrame([(1, 1, 1, 1.0, 0.5, 0.2)], BANDS)
    out = {r.layer_id: (r.events, *map(float, (r.loss, r.reinst_premium, r.brokerage))) for r in layering.scenario_losses(spark.createDataFrame(rows, SCENARIO), reinstatements).collect()}
    assert out == {1: (2, 80.0, 5.0, 1.0), 2: (1, 25.0, 0.0, 0.0)}


def test_reinstatements_in_their_order(spark):
    """One free use of a limit of 100, the next at half the premium of 1000, the third at all of it; then none. Events by date, not
    by key: 60, 100, 100, 140 (up to the limit: 100), of which the last uses 40 of the third and 60 of nothing."""
    dated = [(4, D(2024, 1, 1), 60.0), (3, D(2024, 1, 2), 100.0), (2, D(2024, 1, 3), 100.0), (1, D(2024, 1, 4), 140.0)]
    rows = [(1, k, d, 1, x, 1.0, 3, 1000.0, 100.0, 1000.0, 0.0, 0.0, 0.0, 0.0) for k, d, x in dated]
    bands = spark.createDataFrame([(7, 1, 3, 1.0, 1.0, 0.1), (8, 1, 1, 1.0, 0.0, 0.1), (9, 1, 2, 1.0, 0.5, 0.2), (5, 1, 4, 0.0, 9.0, 0.0)], BANDS)
    events = layering.scenario_event_losses(spark.createDataFrame(rows, SCENARIO))
    out = {(r.event_key, r.band): (float(r.reinst_premium), float(r.brokerage)) for r in layering.reinstated(events, layering.reinstatement_bands(bands), ["event_key"]).collect()}
    assert out == {(4, 1): (0.0, 0.0), (3, 1): (0.0, 0.0), (3, 2): (300.0, 60.0), (2, 2): (200.0, 40.0), (2, 3): (600.0, 60.0), (1, 3): (400.0, 40.0)}


def test_a_long_chain_and_what_joins_it(spark):
    """5,000 edges in a row, a second way into each hundredth vertex, and a ladder of vertices with two edges into each."""
    edges = [(k, k + 1) for k in range(5000)] + [(10000 + k, k * 1000) for k in range(1, 3)]
    edges += [(20000 + k, 20001 + k) for k in range(6)] + [(20000 + k, 20002 + k) for k in range(5)]
    out = {r.vertex: r.depth for r in graph.topological_depth(spark.createDataFrame(edges, "a int, b int"), "a", "b").collect()}
    assert [out[k] for k in (0, 1, 999, 1000, 1001, 4999, 5000)] == [0, 1, 999, 1000, 1001, 4999, 5000]
    assert [out[20000 + k] for k in range(7)] == list(range(7)) and out[10001] == 0


@pytest.mark.parametrize("edges,named", [([(1, 2), (2, 3), (3, 1), (3, 4), (4, 5), (9, 8)], r"\[1, 2, 3\]"), ([(1, 2), (2, 3), (3, 2), (5, 2), (3, 6), (6, 7), (5, 7)], r"\[2\]|\[2, 3\]"), ([(1, 1)], r"\[1\]")])
def test_cycles_are_named(spark, edges, named):
    with pytest.raises(ValueError, match=f"has a cycle: {named}"):
        graph.topological_depth(spark.createDataFrame(edges, "a int, b int"), "a", "b")


def test_franchise(spark):
    df = spark.createDataFrame([(50.0,), (50.5,), (200.0,)], "loss double")
    out = df.select(layering.occurrence_loss(F.col("loss"), F.lit(10.0), F.lit(100.0), F.lit(50.0)).alias("x")).collect()
    assert [r.x for r in out] == [0.0, 40.5, 100.0]


def test_gross_allocations_name_their_investors(spark):
    from inuring.operators import cessions as c

    rows = [(1, 7, 12, 0.1, 0.2, 0.5), (1, 7, 3, 0.3, 0.4, 0.5), (1, 8, 3, 0.3, 0.4, 0.0)]
    alloc = spark.createDataFrame(rows, "retro_program_id int, layer_id int, retro_investor_id int, cession_gross double, cession_before double, placement double")
    out = c.gross_allocations(alloc.withColumns({"l_inception": F.lit(D(2024, 1, 1)), "l_expiration": F.lit(D(2024, 12, 31))})).collect()
    assert {r.layer_id: (r.retro_investors, round(r.after_placement, 9), round(r.gross, 9)) for r in out} == {7: ([3, 12], 0.8, 0.4), 8: ([3], 0.4, 0.3)}
