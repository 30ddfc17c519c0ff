"""Cessions, intervals, currency, metrics, event losses, graphs and layering as queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from inuring.functions import terms as x
from inuring.operators import cessions as c
from inuring.operators import conditional, fx, graph, intervals, layering, metrics
from inuring.operators import yelt as y
from inuring.functions.terms import SHARE
from inuring.operators.metrics import LIMITS, PREMIUMS
from inuring.plans import scans
from inuring.plans.registry import query
from inuring.sources import sinks
from inuring.sources.shared import cut, temporary

FX_DATE, BASE = "1998-06-15", "USD"
YELT_KEY = "day, year, peril_id, event_id"

# --- cessions -------------------------------------------------------------------------------------------------------
BEFORE = "CASE WHEN MAX(target_collateral) = 0 THEN SUM(investment_signed) ELSE SUM(investment_signed_amt) / MAX(target_collateral) END"
RESET = f"SELECT {{0}}p.retro_program_id, p.start_date, p.retro_program_reset_id, SUM(investment_signed_amt) AS amt, MAX(target_collateral) AS collateral, SUM(investment_signed) AS signed, {BEFORE} AS cession_before FROM retro_investor_reset r JOIN retro_program_reset p USING (retro_program_reset_id) GROUP BY {{0}}p.retro_program_id, p.start_date, p.retro_program_reset_id"
INITIAL = f"SELECT {{0}}s.retro_program_id, MIN(p.inception) AS start_date, CAST(-1 AS INT) AS retro_program_reset_id, SUM(investment_signed_amt) AS amt, MAX(target_collateral) AS collateral, SUM(investment_signed) AS signed, {BEFORE} AS cession_before FROM retro_investor r JOIN sp_insurer s USING (sp_insurer_id) JOIN retro_program p ON p.retro_program_id = s.retro_program_id GROUP BY {{0}}s.retro_program_id"
INVESTOR = "r.retro_investor_id, "
ROUNDED = "* REPLACE (ROUND(cession_before, 9) AS cession_before)"
ANTI = "NOT EXISTS (SELECT 1 FROM rc WHERE rc.retro_investor_id = ic.retro_investor_id AND rc.retro_program_id = ic.retro_program_id AND rc.start_date = ic.start_date)"
PERIODS = f"""rc AS ({RESET.format(INVESTOR)}), ic AS ({INITIAL.format(INVESTOR)}),
    periods AS (SELECT retro_investor_id, retro_program_id, start_date, retro_program_reset_id, cession_before FROM rc UNION SELECT retro_investor_id, retro_program_id, start_date, retro_program_reset_id, cession_before FROM ic WHERE {ANTI})"""
PLACEMENTS = "placements AS (SELECT l.layer_id, z.retro_program_id, z.placement FROM layer l JOIN (SELECT retro_program_id, top_up_zone_id, MAX(cession) AS placement FROM retro_zone GROUP BY 1, 2) z ON z.top_up_zone_id = l.top_up_zone_id)"
ALLOC = f"""WITH {PERIODS}, {PLACEMENTS}, ra AS (SELECT a.layer_id, i.retro_program_id, a.retro_investor_id, a.cession_gross, l.inception AS l_inception, l.expiration AS l_expiration, COALESCE(pl.placement, 1.0) AS placement
        FROM retro_allocation a JOIN retro_investor v USING (retro_investor_id) JOIN sp_insurer i USING (sp_insurer_id) JOIN layer l ON l.layer_id = a.layer_id LEFT JOIN placements pl ON pl.layer_id = a.layer_id AND pl.retro_program_id = i.retro_program_id),
    alloc AS (SELECT ra.*, COALESCE(MAX_BY(p.cession_before, p.start_date) FILTER (p.start_date <= ra.l_inception), MIN_BY(p.cession_before, p.start_date)) AS cession_before,
        COALESCE(MAX(p.start_date) FILTER (p.start_date <= ra.l_inception), MIN(p.start_date)) AS start_date
        FROM ra JOIN periods p ON p.retro_investor_id = ra.retro_investor_id AND p.retro_program_id = ra.retro_program_id GROUP BY ALL)"""
SPLIT = "split AS (SELECT d.retro_program_id, d.start_date, COALESCE(LEAD(d.start_date) OVER (PARTITION BY d.retro_program_id ORDER BY d.start_date) - 1, g.expiration) AS end_date FROM (SELECT DISTINCT retro_program_id, start_date FROM periods) d JOIN retro_program g ON g.retro_program_id = d.retro_program_id)"
VIEW = f"""{ALLOC}, {SPLIT},
    gross AS (SELECT retro_program_id, layer_id, SUM(CAST(cession_gross AS DECIMAL(16,10))) AS gross, MIN(l_inception) AS l_inception, MIN(l_expiration) AS l_expiration FROM alloc GROUP BY 1, 2),
    met AS (SELECT g.*, r.stored_level + 1 AS level, r.expiration AS r_expiration,
        CASE WHEN r.retro_program_type = 1 THEN GREATEST(g.l_inception, r.inception) ELSE g.l_inception END AS o_start, CASE WHEN r.retro_program_type = 1 THEN LEAST(g.l_expiration, r.expiration) ELSE g.l_expiration END AS o_end,
        (SELECT COUNT(*) FROM split s WHERE s.retro_program_id = g.retro_program_id) AS n
        FROM gross g JOIN retro_program r ON r.retro_program_id = g.retro_program_id
        WHERE (r.retro_program_type = 1 AND GREATEST(g.l_inception, r.inception) <= LEAST(g.l_expiration, r.expiration)) OR (r.retro_program_type = 2 AND g.l_inception BETWEEN r.inception AND r.expiration)),
    pg AS (SELECT a.retro_program_id, a.layer_id, p.start_date, CAST(SUM(CAST(p.cession_before AS DECIMAL(16,10)) * CAST(CASE WHEN a.placement = 0 THEN a.cession_gross / a.cession_before ELSE a.placement END AS DECIMAL(16,10))) AS DECIMAL(16,10)) AS gross
        FROM alloc a JOIN periods p ON p.retro_program_id = a.retro_program_id AND p.retro_investor_id = a.retro_investor_id GROUP BY 1, 2, 3),
    picked AS (SELECT m.retro_program_id, m.layer_id, COALESCE(MAX(s.start_date) FILTER (s.start_date <= m.l_inception), MIN(s.start_date)) AS start_date FROM met m JOIN split s ON s.retro_program_id = m.retro_program_id WHERE m.n > 1 GROUP BY 1, 2),
    single AS (SELECT layer_id, level, retro_program_id, o_start AS "start", o_end AS "end", gross FROM met WHERE n = 1),
    lod AS (SELECT * FROM single UNION ALL SELECT m.layer_id, m.level, m.retro_program_id, GREATEST(o_start, s.start_date), LEAST(o_end, s.end_date), pg.gross FROM met m JOIN split s ON s.retro_program_id = m.retro_program_id
        JOIN pg ON pg.retro_program_id = m.retro_program_id AND pg.layer_id = m.layer_id AND pg.start_date = s.start_date WHERE m.n > 1 AND GREATEST(o_start, s.start_date) <= LEAST(o_end, s.end_date)),
    rad AS (SELECT * FROM single UNION ALL SELECT m.layer_id, m.level, m.retro_program_id, GREATEST(o_start, k.start_date), LEAST(o_end, m.r_expiration), pg.gross FROM met m JOIN picked k ON k.retro_program_id = m.retro_program_id AND k.layer_id = m.layer_id
        JOIN pg ON pg.retro_program_id = m.retro_program_id AND pg.layer_id = m.layer_id AND pg.start_date = k.start_date WHERE m.n > 1 AND GREATEST(o_start, k.start_date) <= LEAST(o_end, m.r_expiration))"""
# levels are 1 to 3 in the fixtures; each level's share left is the one below times what that level leaves
NET = """k AS (SELECT {u}, level, retro_program_id, "start", "end", CAST(gross AS DECIMAL(16,10)) AS gross FROM {c}),
    moves AS MATERIALIZED (SELECT {u}, d, SUM(g) FILTER (level = 1) AS c1, SUM(g) FILTER (level = 2) AS c2, COUNT(*) FILTER (level = 1) AS n1, COUNT(*) FILTER (level < 3) AS n2
        FROM (SELECT {u}, level, "start" AS d, gross AS g FROM k UNION ALL SELECT {u}, level, "end" + 1, -gross FROM k) GROUP BY {u}, d),
    sums AS (SELECT {u}, d, n1, n2, COALESCE(SUM(c1) OVER w, 0) AS s1, COALESCE(SUM(c2) OVER w, 0) AS s2 FROM moves WINDOW w AS (PARTITION BY {u} ORDER BY d)),
    lefts AS (SELECT *, CAST(1 - s1 AS DECIMAL(16,10)) AS left2 FROM sums),
    bounds AS (SELECT {u}, 2 AS level, d, left2 AS share FROM lefts WHERE n1 > 0 UNION ALL SELECT {u}, 3, d, CAST(left2 * CAST(1 - s2 AS DECIMAL(16,10)) AS DECIMAL(16,10)) FROM lefts WHERE n2 > 0),
    spans AS MATERIALIZED (SELECT {u}, level, d AS a, COALESCE(LEAD(d) OVER (PARTITION BY {u}, level ORDER BY d) - 1, DATE '9999-01-01') AS b, share FROM bounds
        UNION ALL SELECT {u}, level, DATE '0001-01-01', MIN(d) - 1, 1 FROM bounds GROUP BY {u}, level UNION ALL SELECT {u}, level, DATE '0001-01-01', DATE '9999-01-01', 1 FROM (SELECT DISTINCT {u}, level FROM k EXCEPT SELECT {u}, level FROM bounds)),
    net AS (SELECT k.{u}, k.level, k.retro_program_id, GREATEST(k."start", s.a) AS "start", LEAST(k."end", s.b) AS "end", k.gross, CAST(k.gross * CAST(s.share AS DECIMAL(16,10)) AS DECIMAL(16,10)) AS net
        FROM k JOIN spans s ON s.{u} = k.{u} AND s.level = k.level AND s.a <= k."end" AND s.b >= k."start")"""
VIEW_OUT = 'SELECT layer_id, CAST(level AS INT) AS level, retro_program_id, "start", "end", CAST(ROUND(gross, 7) AS DOUBLE) AS gross FROM '
NET_OUT = 'SELECT {u}, CAST(level AS INT) AS level, retro_program_id, "start", "end", CAST(ROUND(gross, 7) AS DOUBLE) AS gross, CAST(ROUND(net, 7) AS DOUBLE) AS net FROM net'


def exact(df, *names, digits=7):
    """Decimals rounded half up, as doubles."""
    return df.withColumns({n: F.round(n, digits).cast("double") for n in names})


def rounded(df, *names, digits=7):
    """Sums of products don't depend on the order of rows beyond these digits; adding 0 removes the sign of zero."""
    return df.withColumns({n: F.round(n, digits) + 0 for n in names})


@query("investor_reset_cessions", f"SELECT {ROUNDED} FROM ({RESET.format(INVESTOR)})")
def investor_reset_cessions(t):
    return rounded(c.reset_cessions(t, True), "cession_before", digits=9)


@query("investor_initial_cessions", f"SELECT {ROUNDED} FROM ({INITIAL.format(INVESTOR)})")
def investor_initial_cessions(t):
    return rounded(c.initial_cessions(t, True), "cession_before", digits=9)


@query("retro_reset_cessions", f"SELECT {ROUNDED} FROM ({RESET.format('')})")
def retro_reset_cessions(t):
    return rounded(c.reset_cessions(t, False), "cession_before", digits=9)


@query("retro_initial_cessions", f"SELECT {ROUNDED} FROM ({INITIAL.format('')})")
def retro_initial_cessions(t):
    return rounded(c.initial_cessions(t, False), "cession_before", digits=9)


@query("initial_cessions_anti", f"WITH rc AS ({RESET.format(INVESTOR)}), ic AS ({INITIAL.format(INVESTOR)}) SELECT {ROUNDED} FROM ic WHERE {ANTI}")
def initial_cessions_anti(t):
    return rounded(c.initial_without_reset(t), "cession_before", digits=9)


@query("investor_cession_periods", f"WITH {PERIODS} SELECT {ROUNDED} FROM periods")
def investor_cession_periods(t):
    return rounded(c.cession_periods(t), "cession_before", digits=9)


@query("layer_retro_placement", f"WITH {PLACEMENTS} SELECT * FROM placements")
def layer_retro_placement(t):
    return c.placements(t)


@query("placement_default", f"{ALLOC} SELECT layer_id, retro_program_id, retro_investor_id, placement FROM alloc")
def placement_default(t):
    return c.allocations(t).select("layer_id", "retro_program_id", "retro_investor_id", "placement")


@query("cession_asof", f"{ALLOC} SELECT layer_id, retro_program_id, retro_investor_id, start_date, ROUND(cession_before, 9) AS cession_before FROM alloc")
def cession_asof(t):
    return c.allocations(t).select("layer_id", "retro_program_id", "retro_investor_id", "start_date", F.round("cession_before", 9).alias("cession_before"))


@query("gross_allocation", f"{ALLOC} SELECT retro_program_id, layer_id, ROUND(SUM(cession_before), 7) AS before_placement, ROUND(SUM(CASE WHEN placement = 0 THEN cession_before ELSE cession_gross / placement END), 7) AS after_placement, MAX(placement) AS placement, ROUND(SUM(cession_gross), 7) AS gross, string_agg(CAST(retro_investor_id AS VARCHAR), ',' ORDER BY retro_investor_id) AS retro_investors FROM alloc GROUP BY 1, 2")
def gross_allocation(t):
    gross = c.gross_allocations(c.allocations(t)).drop("l_inception", "l_expiration")
    gross = gross.withColumn("retro_investors", F.array_join(F.col("retro_investors").cast("array<string>"), ","))
    return rounded(gross, "before_placement", "after_placement", "gross")


@query("reset_dates", f"WITH {PERIODS} SELECT DISTINCT retro_program_id, start_date FROM periods")
def reset_dates(t):
    return c.cession_periods(t).select("retro_program_id", "start_date").distinct()


@query("reset_periods", f"WITH {PERIODS}, {SPLIT} SELECT * FROM split")
def reset_periods(t):
    return c.reset_periods(c.cession_periods(t), t.retro_program)


@query("reset_gross_cession", f"{VIEW} SELECT retro_program_id, layer_id, start_date, CAST(ROUND(gross, 7) AS DOUBLE) AS gross FROM pg")
def reset_gross_cession(t):
    periods = cut(c.cession_periods(t))
    return exact(c.period_gross(c.allocations(t, periods), periods), "gross")


@query("rad_reset_pick", f"{VIEW} SELECT layer_id, retro_program_id, start_date FROM picked")
def rad_reset_pick(t):
    view = _met(t).join(c.cession_periods(t).groupBy("retro_program_id").agg(F.countDistinct("start_date").alias("n")).where("n > 1"), "retro_program_id")
    requests = view.select("layer_id", "retro_program_id", "l_inception")
    return c.as_of_periods(requests, c.cession_periods(t).select("retro_program_id", "start_date").distinct(), ["retro_program_id"], "l_inception").select("layer_id", "retro_program_id", "start_date")


def _met(t):
    programs = t.retro_program.select("retro_program_id", "retro_program_type", F.col("inception").alias("r_inception"), F.col("expiration").alias("r_expiration"))
    pairs = y.retro_layers(t).select("layer_id", "retro_program_id").join(programs, "retro_program_id").join(t.layer.select("layer_id", F.col("inception").alias("l_inception"), F.col("expiration").alias("l_expiration")), "layer_id")
    return intervals.layer_overlap(pairs, F.col("retro_program_type"))


OVERLAP = 'SELECT a.layer_id, a.retro_program_id, {0} FROM (SELECT DISTINCT layer_id, retro_program_id FROM retro_allocation JOIN retro_investor USING (retro_investor_id) JOIN sp_insurer USING (sp_insurer_id)) a JOIN retro_program r ON r.retro_program_id = a.retro_program_id JOIN layer l ON l.layer_id = a.layer_id WHERE {1}'


@query("layer_retro_overlap_lod", OVERLAP.format('GREATEST(l.inception, r.inception) AS "start", LEAST(l.expiration, r.expiration) AS "end"', "retro_program_type = 1 AND GREATEST(l.inception, r.inception) <= LEAST(l.expiration, r.expiration)"))
def layer_retro_overlap_lod(t):
    return _met(t).where("retro_program_type = 1").select("layer_id", "retro_program_id", "start", "end")


@query("layer_retro_overlap_rad", OVERLAP.format('l.inception AS "start", l.expiration AS "end"', "retro_program_type = 2 AND l.inception BETWEEN r.inception AND r.expiration"))
def layer_retro_overlap_rad(t):
    return _met(t).where("retro_program_type = 2").select("layer_id", "retro_program_id", "start", "end")


@query("retro_cession_view_lod", f"{VIEW}, {NET.format(c='lod', u='layer_id')} {NET_OUT.format(u='layer_id')}")
def retro_cession_view_lod(t):
    return exact(intervals.net_cessions(c.cession_view(t, x.LOD), "layer_id", ["retro_program_id"]), "gross", "net")


@query("retro_cession_view_rad", f"{VIEW}, {NET.format(c='rad', u='layer_id')} {NET_OUT.format(u='layer_id')}")
def retro_cession_view_rad(t):
    return exact(intervals.net_cessions(c.cession_view(t, x.RAD), "layer_id", ["retro_program_id"]), "gross", "net")


@query("gross_cession_view", f"{VIEW} {VIEW_OUT} lod")
def gross_cession_view(t):
    return exact(c.cession_view(t, x.LOD), "gross")


# --- portfolios -----------------------------------------------------------------------------------------------------
PORT = """moved AS (SELECT pl.port_layer_id, pl.layer_id, pl.portfolio_id, l.inception,
        CASE WHEN portfolio_type = 0 THEN 0 WHEN portfolio_type = 1 THEN 1
            WHEN portfolio_type IN (2, 3) AND year(as_of_date) - year(l.inception) IN (0, 1) THEN portfolio_type - 2 + year(as_of_date) - year(l.inception) END AS years
        FROM port_layer pl JOIN portfolio p USING (portfolio_id) JOIN layer l ON l.layer_id = pl.layer_id),
    port AS (SELECT port_layer_id, layer_id, portfolio_id, CAST(inception + TO_YEARS(CAST(years AS INTEGER)) AS DATE) AS inception,
        CAST(CAST(inception + TO_YEARS(CAST(years AS INTEGER)) AS DATE) + INTERVAL 1 YEAR - INTERVAL 1 DAY AS DATE) AS expiration FROM moved WHERE years IS NOT NULL)"""
PORT_C = f"""WITH {PORT}, c AS (SELECT k.port_layer_id, r.stored_level + 1 AS level, k.retro_program_id,
        CASE WHEN r.retro_program_type = 2 THEN p.inception ELSE GREATEST(p.inception, r.inception) END AS "start",
        CASE WHEN r.retro_program_type = 2 THEN p.expiration ELSE LEAST(p.expiration, r.expiration) END AS "end", k.cession_gross AS gross
    FROM port_layer_cession k JOIN port p ON p.port_layer_id = k.port_layer_id JOIN retro_program r ON r.retro_program_id = k.retro_program_id
    WHERE k.cession_gross > 0 AND k.should_cession_apply AND p.inception <= r.expiration AND p.expiration >= r.inception
        AND (r.retro_program_type = 1 OR p.inception >= r.inception))"""


def portfolio_periods(t):
    """Port layers with the year from the inception that their portfolio's type gives them (see ``cessions.portfolio_year``)."""
    met = t.port_layer.join(t.portfolio, "portfolio_id").join(t.layer.select("layer_id", "inception"), "layer_id")
    met = c.portfolio_year(met, "portfolio_type", "as_of_date", "inception")
    return met.select("port_layer_id", "layer_id", "portfolio_id", "inception", "expiration")


def portfolio_cessions(t):
    met = t.port_layer_cession.where("cession_gross > 0 AND should_cession_apply").join(portfolio_periods(t), "port_layer_id")
    programs = t.retro_program.select(
        "retro_program_id", "retro_program_type", F.col("inception").alias("ri"), F.col("expiration").alias("re"), (F.col("stored_level") + 1).alias("level")
    )
    met = met.join(programs, "retro_program_id").where("inception <= re AND expiration >= ri")
    kind = F.col("retro_program_type")
    # but for losses occurring, a layer has to incept after the program
    met = met.where((kind == x.LOD) | (F.col("inception") >= F.col("ri")))
    start = F.when(kind == x.RAD, F.col("inception")).otherwise(F.greatest("inception", "ri"))
    end = F.when(kind == x.RAD, F.col("expiration")).otherwise(F.least("expiration", "re"))
    return met.select("port_layer_id", "level", "retro_program_id", start.alias("start"), end.alias("end"), F.col("cession_gross").alias("gross"))


@query("portfolio_inception", f"WITH {PORT} SELECT * FROM port")
def portfolio_inception(t):
    return portfolio_periods(t)


@query("portfolio_overlap", f'{PORT_C} SELECT port_layer_id, CAST(level AS INT) AS level, retro_program_id, "start", "end", gross FROM c')
def portfolio_overlap(t):
    return portfolio_cessions(t)


@query("portfolio_retro_cession_view", f"{PORT_C}, {NET.format(c='c', u='port_layer_id')} {NET_OUT.format(u='port_layer_id')}")
@query("portfolio_net_cessions", f"{PORT_C}, {NET.format(c='c', u='port_layer_id')} {NET_OUT.format(u='port_layer_id')}")
def portfolio_net_cessions(t):
    return exact(intervals.net_cessions(portfolio_cessions(t), "port_layer_id", ["retro_program_id"]), "gross", "net")


@query("cessions_in_force", f"{PORT_C}, {NET.format(c='c', u='port_layer_id')} {NET_OUT.format(u='port_layer_id')} WHERE \"start\" <= DATE '1997-06-30' AND \"end\" >= DATE '1997-06-30'")
def cessions_in_force(t):
    """Gross and net cessions by level on a day."""
    net = intervals.net_cessions(portfolio_cessions(t), "port_layer_id", ["retro_program_id"])
    return exact(net.where("start <= DATE '1997-06-30' AND end >= DATE '1997-06-30'"), "gross", "net")


@query("net_to_gross", f"{PORT_C}, {NET.format(c='c', u='port_layer_id')} SELECT port_layer_id, retro_program_id, \"start\", \"end\", CAST(CAST(CASE WHEN gross = 0 THEN 0 ELSE CAST(net AS DOUBLE) / CAST(gross AS DOUBLE) END AS DECIMAL(16,10)) AS DOUBLE) AS ratio FROM net")
def net_to_gross(t):
    """The share of each port layer's gross cession that the levels below leave it."""
    net = intervals.net_cessions(portfolio_cessions(t), "port_layer_id", ["retro_program_id"])
    return net.select("port_layer_id", "retro_program_id", "start", "end", x.ratio(F.col("net").cast("double"), F.col("gross").cast("double")).cast(SHARE).cast("double").alias("ratio"))


# --- intervals ------------------------------------------------------------------------------------------------------
PAIRS = "FROM port_layer_cession k JOIN layer l ON l.layer_id = k.port_layer_id // 10 JOIN retro_program r ON r.retro_program_id = k.retro_program_id"


def _pairs(t):
    met = t.port_layer_cession.withColumn("layer_id", F.floor(F.col("port_layer_id") / 10).cast("int")).join(t.layer.select("layer_id", "inception", "expiration"), "layer_id")
    return met.join(t.retro_program.select("retro_program_id", F.col("inception").alias("ri"), F.col("expiration").alias("re")), "retro_program_id")


IDS = ["layer_id", "retro_program_id", "start", "end"]


@query("interval_left", f'SELECT l.layer_id, k.retro_program_id, l.inception AS "start", LEAST(l.expiration, r.inception - 1) AS "end" {PAIRS} WHERE l.inception <= LEAST(l.expiration, r.inception - 1)')
def interval_left(t):
    return intervals.left_of(_pairs(t), "inception", "expiration", "ri").select(IDS)


@query("interval_right", f'SELECT l.layer_id, k.retro_program_id, GREATEST(l.inception, r.expiration + 1) AS "start", l.expiration AS "end" {PAIRS} WHERE GREATEST(l.inception, r.expiration + 1) <= l.expiration')
def interval_right(t):
    return intervals.right_of(_pairs(t), "inception", "expiration", "re").select(IDS)


@query("interval_overlap", f'SELECT l.layer_id, k.retro_program_id, GREATEST(l.inception, r.inception) AS "start", LEAST(l.expiration, r.expiration) AS "end" {PAIRS} WHERE GREATEST(l.inception, r.inception) <= LEAST(l.expiration, r.expiration)')
def interval_overlap(t):
    return intervals.overlap(_pairs(t), "inception", "expiration", "ri", "re").select(IDS)


@query("elementary_intervals", f"""{PORT_C}, b AS (SELECT port_layer_id, level, "start" AS cut_at FROM c UNION SELECT port_layer_id, level, "end" + 1 FROM c), e AS (SELECT *, LEAD(cut_at) OVER (PARTITION BY port_layer_id, level ORDER BY cut_at) - 1 AS until FROM b)
    SELECT e.port_layer_id, CAST(e.level AS INT) AS level, e.cut_at AS "start", e.until AS "end", ROUND(SUM(c.gross), 9) AS value FROM e JOIN c ON c.port_layer_id = e.port_layer_id AND c.level = e.level AND c."start" <= e.cut_at AND c."end" >= e.cut_at WHERE until IS NOT NULL GROUP BY ALL HAVING ROUND(SUM(c.gross), 9) <> 0""")
def elementary_intervals(t):
    return intervals.elementary_intervals(portfolio_cessions(t), ["port_layer_id", "level"], "start", "end", "gross")


@query("net_cessions", f"{VIEW}, whole AS (SELECT layer_id, level, retro_program_id, o_start AS \"start\", o_end AS \"end\", gross FROM met), {NET.format(c='whole', u='layer_id')} {NET_OUT.format(u='layer_id')}")
def net_cessions(t):
    """Without resets: every program with the whole overlap of its period and the layer's."""
    alloc = c.allocations(t).groupBy("retro_program_id", "layer_id").agg(F.sum(F.col("cession_gross").cast(SHARE)).cast(SHARE).alias("gross"), F.min("l_inception").alias("l_inception"), F.min("l_expiration").alias("l_expiration"))
    programs = t.retro_program.select("retro_program_id", (F.col("stored_level") + 1).alias("level"), "retro_program_type", F.col("inception").alias("r_inception"), F.col("expiration").alias("r_expiration"))
    met = intervals.layer_overlap(alloc.join(programs, "retro_program_id"), F.col("retro_program_type"))
    return exact(intervals.net_cessions(met, "layer_id", ["retro_program_id"]), "gross", "net")


D1, D2 = "LEAST(dayofyear(inception), 365)", "LEAST(dayofyear(expiration), 365)"


@query("yelt_day_ranges", f"""WITH p AS (SELECT layer_id, inception, CAST(inception + CAST(30 + layer_id % 400 AS INTEGER) AS DATE) AS expiration FROM layer), d AS (SELECT *, {D1} AS a, {D2} AS b, expiration - inception + 1 >= 365 AS whole FROM p)
    SELECT layer_id, CAST(1 AS INT) AS first_day, CAST(365 AS INT) AS last_day FROM d WHERE whole UNION ALL SELECT layer_id, CAST(a AS INT), CAST(b AS INT) FROM d WHERE NOT whole AND a <= b
    UNION ALL SELECT layer_id, CAST(1 AS INT), CAST(b AS INT) FROM d WHERE NOT whole AND a > b UNION ALL SELECT layer_id, CAST(a AS INT), CAST(365 AS INT) FROM d WHERE NOT whole AND a > b""")
def yelt_day_ranges(t):
    periods = t.layer.select("layer_id", "inception", F.expr("date_add(inception, 30 + layer_id % 400)").alias("expiration"))
    return intervals.day_ranges(periods, "inception", "expiration").select("layer_id", "first_day", "last_day")


# --- currency -------------------------------------------------------------------------------------------------------
RATE = "CASE WHEN {b} = {c} THEN 1.0 ELSE COALESCE((SELECT f.rate FROM fx_rate f WHERE f.fx_date = {d} AND f.base_currency = {b} AND f.currency = {c}), (SELECT MIN_BY(y.rate / x.rate, x.base_currency) FROM fx_rate x JOIN fx_rate y ON y.fx_date = x.fx_date AND y.base_currency = x.base_currency WHERE x.fx_date = {d} AND x.currency = {b} AND y.currency = {c})) END"
CLOSEST = "(SELECT MAX(fx_date) FROM fx_rate WHERE fx_date <= {0})"


def _request(t, base: str):
    return t.layer.select("layer_id", "inception", F.lit(base).alias("base"), F.when(F.col("layer_id") % 3 == 0, "EUR").when(F.col("layer_id") % 3 == 1, "GBP").otherwise("CAD").alias("currency"))


REQUEST = "q AS (SELECT layer_id, inception, '{0}' AS base, CASE layer_id % 3 WHEN 0 THEN 'EUR' WHEN 1 THEN 'GBP' ELSE 'CAD' END AS currency, " + CLOSEST.format("inception") + " AS d FROM layer)"


@query("fx_asof", f"WITH {REQUEST.format('USD')} SELECT layer_id, currency, ROUND({RATE.format(b='base', c='q.currency', d='q.d')}, 9) AS rate FROM q")
def fx_asof(t):
    return fx.rates_as_of(_request(t, "USD"), t.fx_rate, "inception", "base", "currency").select("layer_id", "currency", F.round("rate", 9).alias("rate"))


@query("fx_triangulate", f"WITH {REQUEST.format('JPY')} SELECT layer_id, currency, ROUND({RATE.format(b='base', c='q.currency', d='q.d')}, 9) AS rate FROM q")
def fx_triangulate(t):
    return fx.rates_as_of(_request(t, "JPY"), t.fx_rate, "inception", "base", "currency").select("layer_id", "currency", F.round("rate", 9).alias("rate"))


UNBOUND = "(l.status <> 10 OR l.bound_fx_date IS NULL OR l.bound_fx_rate IS NULL)"
LAYER_FX = f"""b AS (SELECT l.layer_id, s.base_currency AS own_base, s.currency AS own, CASE WHEN {UNBOUND} THEN s.fx_rate ELSE l.bound_fx_rate END AS f, {CLOSEST.format(f"(CASE WHEN {UNBOUND} THEN s.fx_date ELSE l.bound_fx_date END)")} AS d FROM layer l JOIN submission s ON s.submission_id = l.submission_id),
    layer_fx AS (SELECT layer_id, CASE WHEN own = '{BASE}' THEN 1.0 ELSE f * {RATE.format(b=f"'{BASE}'", c='b.own_base', d='b.d')} END AS fx FROM b)"""


@query("layer_fx_rate", f"WITH {LAYER_FX} SELECT layer_id, ROUND(fx, 9) AS fx FROM layer_fx")
def layer_fx_rate(t):
    return rounded(fx.layer_rates(t.layer, t.submission, t.fx_rate, True, FX_DATE, BASE, x.BOUND).drop("asked"), "fx", digits=9)


@query("layer_fx_rate_current", f"WITH b AS (SELECT l.layer_id, s.currency AS own, {CLOSEST.format(f"DATE '{FX_DATE}'")} AS d FROM layer l JOIN submission s ON s.submission_id = l.submission_id) SELECT layer_id, ROUND({RATE.format(b=f"'{BASE}'", c='b.own', d='b.d')}, 9) AS fx FROM b")
def layer_fx_rate_current(t):
    return rounded(fx.layer_rates(t.layer, t.submission, t.fx_rate, False, FX_DATE, BASE, x.BOUND).drop("asked"), "fx", digits=9)


# --- metrics --------------------------------------------------------------------------------------------------------
SHARED = "CAST(CASE WHEN signed_share > 0 THEN signed_share ELSE estimated_share END AS DECIMAL(16,10))"
MONEY_TIMES = lambda value, *factors: MONEY_TIMES(f"CAST({value} * CAST({factors[0]} AS DECIMAL(16,10)) AS DECIMAL(20,8))", *factors[1:]) if factors else value
SIZED = lambda value: MONEY_TIMES(f"CAST({value} AS DECIMAL(20,8))", SHARED, "fx", "CASE tran_type WHEN 2 THEN -1 WHEN 1 THEN 1 ELSE 0 END")
METRICS = f"""{VIEW}, {NET.format(c='rad', u='layer_id')}, {LAYER_FX}, t0 AS MATERIALIZED (SELECT l.layer_id, l.inception, l.expiration, l.status, {SIZED("CASE WHEN l.placement = 0 THEN 0 ELSE l.premium / l.placement END")} AS deposit_premium,
        {SIZED("CASE WHEN limit_basis = 1 THEN agg_limit WHEN limit_basis IN (4, 7) THEN risk_limit ELSE occ_limit END")} AS deposit_limit FROM layer l JOIN submission s ON s.submission_id = l.submission_id JOIN layer_fx x ON x.layer_id = l.layer_id),
    m0 AS (SELECT n.*, inception, expiration, status, deposit_premium, deposit_limit, COALESCE(pl.placement, 1.0) AS rp, CAST(CASE WHEN gross = 0 THEN 0 ELSE CAST(net AS DOUBLE) / CAST(gross AS DOUBLE) END AS DECIMAL(16,10)) AS ng,
        CAST(CAST("end" - "start" + 1 AS DOUBLE) / (expiration - inception + 1) AS DECIMAL(16,10)) AS part
        FROM net n JOIN t0 ON t0.layer_id = n.layer_id LEFT JOIN placements pl ON pl.layer_id = n.layer_id AND pl.retro_program_id = n.retro_program_id),
    m1 AS (SELECT *, {MONEY_TIMES("deposit_premium", "part")} AS available FROM m0),
    m2 AS (SELECT *, {MONEY_TIMES("available", "ng")} AS subject_premium, {MONEY_TIMES("deposit_limit", "ng")} AS subject_limit FROM m1),
    m AS MATERIALIZED (SELECT *, {MONEY_TIMES("available", "net")} AS ceded_premium, {MONEY_TIMES("subject_premium", "rp")} AS subject_placed_premium, {MONEY_TIMES("subject_limit", "rp")} AS subject_placed_limit, {MONEY_TIMES("deposit_limit", "net")} AS ceded_limit FROM m2)"""
AS_DOUBLE = lambda value, digits: f"CAST(ROUND({value}, {digits}) AS DOUBLE)"
ROUND3 = lambda names: ", ".join(f"{AS_DOUBLE(n, 3)} AS {n}" for n in names)
SUM2 = ", ".join(f"{AS_DOUBLE(f'SUM({n})', 2)} AS {n}" for n in PREMIUMS)


def by_layer(t, reset_type=x.RAD, current=FX_DATE, base=BASE, use_bound=True, programs=None, statuses=None, missing="fail", audit=None):
    """Metrics of each piece of net cession. ``reset_type`` chooses the periods, ``base`` the currency, ``use_bound`` the bound
    rates of layers rather than those of the ``current`` date; ``programs`` and ``statuses`` keep some retro programs (after
    all have been netted) and layers of some statuses. A missing rate fails the run; see ``metrics.layer_metrics`` for other ways."""
    net = intervals.net_cessions(c.cession_view(t, reset_type), "layer_id", ["retro_program_id"])
    if programs is not None:
        net = net.where(F.col("retro_program_id").isin(*programs))
    layers = t.layer if statuses is None else t.layer.where(F.col("status").isin(*statuses))
    rates = fx.layer_rates(t.layer, t.submission, t.fx_rate, use_bound, current, base, x.BOUND)
    return metrics.layer_metrics(net, layers, t.submission, rates, cut(c.zone_placements(t)), missing, audit)


@query("retro_layer_metrics", f'{METRICS} SELECT layer_id, CAST(level AS INT) AS level, retro_program_id, "start", "end", status, {ROUND3(("deposit_premium",) + PREMIUMS + LIMITS)} FROM m')
def retro_layer_metrics(t):
    return exact(by_layer(t).select("layer_id", "level", "retro_program_id", "start", "end", "status", "deposit_premium", *PREMIUMS, *LIMITS), "deposit_premium", *PREMIUMS, *LIMITS, digits=3)


PEAK = """(SELECT retro_program_id, MAX(v) AS peak FROM (SELECT retro_program_id, SUM(v) OVER w AS v, SUM(n) OVER w AS n FROM (SELECT retro_program_id, d, SUM(v) AS v, SUM(n) AS n FROM (SELECT retro_program_id, "start" AS d, {0} AS v, 1 AS n FROM m UNION ALL SELECT retro_program_id, "end" + 1, -{0}, -1 FROM m) GROUP BY 1, 2) WINDOW w AS (PARTITION BY retro_program_id ORDER BY d)) WHERE n > 0 GROUP BY 1)"""


@query("retro_metrics", f"""{METRICS} SELECT s.*, {AS_DOUBLE("p.peak", 2)} AS peak_ceded_limit, {AS_DOUBLE("q.peak", 2)} AS peak_subject_limit FROM (SELECT retro_program_id, {SUM2} FROM m GROUP BY 1) s
    JOIN {PEAK.format('ceded_limit')} p USING (retro_program_id) JOIN {PEAK.format('subject_limit')} q USING (retro_program_id)""")
def retro_metrics(t):
    return exact(metrics.program_metrics(by_layer(t)), *PREMIUMS, "peak_ceded_limit", "peak_subject_limit", digits=2)


@query("retro_premium_metrics", f"{METRICS} SELECT retro_program_id, {SUM2} FROM m WHERE status IN (10, 22) GROUP BY 1")
def retro_premium_metrics(t):
    kept = by_layer(t, statuses=(10, 22))
    return exact(kept.groupBy("retro_program_id").agg(*[F.sum(n).alias(n) for n in PREMIUMS]), *PREMIUMS, digits=2)


@query("premium_by_profile", f"""{METRICS} SELECT g.retro_profile_id, {AS_DOUBLE("SUM(ceded_premium) FILTER (year(m.inception) = 1996)", 2)} AS y1996, {AS_DOUBLE("SUM(ceded_premium) FILTER (year(m.inception) = 1997)", 2)} AS y1997
    FROM m JOIN retro_program g ON g.retro_program_id = m.retro_program_id WHERE year(m.inception) IN (1996, 1997) GROUP BY 1""")
def premium_by_profile(t):
    met = by_layer(t).join(t.retro_program.select("retro_program_id", "retro_profile_id"), "retro_program_id")
    wide = met.where(F.year("inception").isin(1996, 1997)).withColumn("uw_year", F.concat(F.lit("y"), F.year("inception").cast("string"))).groupBy("retro_profile_id").pivot("uw_year", ["y1996", "y1997"]).agg(F.sum("ceded_premium"))
    return exact(wide, "y1996", "y1997", digits=2)


PEAK_C = 'WITH m AS (SELECT retro_program_id, l.inception AS "start", l.expiration AS "end", CAST(CAST(occ_limit AS DECIMAL(20,8)) * CAST(k.cession_gross AS DECIMAL(16,10)) AS DECIMAL(20,8)) AS v ' + PAIRS.replace("JOIN retro_program r ON r.retro_program_id = k.retro_program_id", "") + ")"


@query("peak_daily_limit", f"{PEAK_C} SELECT retro_program_id, CAST(ROUND(peak, 4) AS DOUBLE) AS peak FROM {PEAK.format('v')}")
def peak_daily_limit(t):
    met = t.port_layer_cession.withColumn("layer_id", F.floor(F.col("port_layer_id") / 10).cast("int")).join(t.layer, "layer_id").withColumn("v", x.times(F.col("occ_limit").cast(x.MONEY), F.col("cession_gross")))
    return exact(metrics.peak_limits(met, ["retro_program_id"], "inception", "expiration", "v"), "peak", digits=4)


# --- event losses ---------------------------------------------------------------------------------------------------
CEDED = "SELECT layer_id, SUM(cession_gross) AS cession FROM retro_allocation GROUP BY layer_id"
LOSSES = f"SELECT day, year, peril_id, event_id, ROUND(SUM(loss_pct * cession), 7) AS loss FROM layer_yelt JOIN ({CEDED}) USING (layer_id) {{0}} GROUP BY ALL"


def _ceded(t):
    return t.retro_allocation.groupBy("layer_id").agg(F.sum("cession_gross").alias("cession"))


for _name in ("event_losses", "event_losses_spmv"):
    query(_name, LOSSES.format(""))(lambda t: rounded(y.event_losses(t.layer_yelt, _ceded(t)), "loss"))


@query("yelt_day_partition", LOSSES.format("WHERE day BETWEEN 50 AND 120"))
def yelt_day_partition(t):
    return rounded(y.event_losses(y.day_partition(t.layer_yelt, 50, 120), _ceded(t)), "loss")


@query("yelt_partition_length", "SELECT layer_id, COUNT(*) AS entries FROM layer_yelt WHERE day BETWEEN 50 AND 120 GROUP BY layer_id")
def yelt_partition_length(t):
    return y.day_partition(t.layer_yelt, 50, 120).groupBy("layer_id").agg(F.count("*").alias("entries"))


@query("merged_keys", "SELECT DISTINCT day, year, peril_id, event_id FROM layer_yelt")
def merged_keys(t):
    return y.merged_keys(t.layer_yelt)


@query("event_index", "SELECT *, ROW_NUMBER() OVER (ORDER BY day, year, peril_id, event_id) - 1 AS place FROM (SELECT DISTINCT day, year, peril_id, event_id FROM layer_yelt)")
def event_index(t):
    return y.event_index(t.layer_yelt)


@query("yelt_sorted", "SELECT layer_id, ROW_NUMBER() OVER (PARTITION BY layer_id ORDER BY day, year, peril_id, event_id) AS place, day, year, peril_id, event_id FROM layer_yelt")
def yelt_sorted(t):
    from pyspark.sql import Window

    place = F.row_number().over(Window.partitionBy("layer_id").orderBy(*y.KEY)).cast("long")
    return t.layer_yelt.select("layer_id", place.alias("place"), *y.KEY)


LATEST = "SELECT layer_id, loss_view, loss_analysis_id, row_version FROM layer_loss_analysis QUALIFY ROW_NUMBER() OVER (PARTITION BY layer_id, loss_view ORDER BY row_version DESC) = 1"


@query("latest_loss_analysis", LATEST)
def latest_loss_analysis(t):
    return y.latest_analyses(t.layer_loss_analysis.select("layer_id", "loss_view", "loss_analysis_id", "row_version")).select("layer_id", "loss_view", "loss_analysis_id", "row_version")


PROJECTED = """SELECT layer_id, loss_view, loss_analysis_id, row_version FROM (SELECT layer_id, CAST(CASE loss_view WHEN 10 THEN 1 WHEN 30 THEN 3 WHEN 11 THEN 1 WHEN 33 THEN 3 WHEN 44 THEN 4 ELSE loss_view END AS INT) AS loss_view,
    CASE WHEN loss_view IN (10, 30, 11, 33, 44) THEN 0 WHEN loss_view IN (1, 3, 4) THEN 1 ELSE 2 END AS priority, loss_analysis_id, row_version FROM layer_loss_analysis) QUALIFY ROW_NUMBER() OVER (PARTITION BY layer_id, loss_view ORDER BY priority, row_version DESC) = 1"""


@query("latest_projected", PROJECTED)
def latest_projected(t):
    return y.projected_analyses(t.layer_loss_analysis.select("layer_id", "loss_view", "loss_analysis_id", "row_version")).select("layer_id", "loss_view", "loss_analysis_id", "row_version")


RETRO = "(SELECT DISTINCT layer_id, retro_program_id FROM retro_allocation JOIN retro_investor USING (retro_investor_id) JOIN sp_insurer USING (sp_insurer_id))"


ENTRIES = f"""chosen AS MATERIALIZED ({PROJECTED}), entries AS MATERIALIZED (SELECT c.loss_view, c.loss_analysis_id, c.layer_id, y.day, y.year, y.peril_id, y.event_id, y.loss_pct
        FROM layer_analysis_yelt y JOIN chosen c ON c.loss_analysis_id = y.loss_analysis_id AND c.layer_id = y.layer_id),
    counted AS (SELECT loss_view, loss_analysis_id, layer_id, COUNT(*) AS entries FROM entries GROUP BY ALL)"""
PERIODS = """g AS (SELECT layer_id, retro_program_id, SUM(cession_gross) AS cession FROM retro_allocation JOIN retro_investor USING (retro_investor_id) JOIN sp_insurer USING (sp_insurer_id) GROUP BY 1, 2),
    o AS (SELECT g.*, CASE WHEN retro_program_type = 1 THEN GREATEST(l.inception, r.inception) ELSE l.inception END AS "start", CASE WHEN retro_program_type = 1 THEN LEAST(l.expiration, r.expiration) ELSE l.expiration END AS "end"
        FROM g JOIN layer l ON l.layer_id = g.layer_id JOIN retro_program r ON r.retro_program_id = g.retro_program_id
        WHERE (retro_program_type = 1 AND l.inception <= r.expiration AND l.expiration >= r.inception) OR (retro_program_type = 2 AND l.inception BETWEEN r.inception AND r.expiration)),
    d AS (SELECT *, LEAST(dayofyear("start"), 365) AS a, LEAST(dayofyear("end"), 365) AS b, "end" - "start" + 1 >= 365 AS whole FROM o),
    ranges AS (SELECT layer_id, retro_program_id, cession, CASE WHEN whole THEN 1 ELSE a END AS first_day, CASE WHEN whole OR a > b THEN 365 ELSE b END AS last_day FROM d
        UNION ALL SELECT layer_id, retro_program_id, cession, 1, b FROM d WHERE NOT whole AND a > b)"""


def _chosen_entries(t):
    """Entries of each layer's chosen analysis of each view, after revised views have taken the place of those they revise."""
    chosen = y.projected_analyses(t.layer_loss_analysis.select("layer_id", "loss_view", "loss_analysis_id", "row_version"))
    return y.analysis_entries(t.layer_analysis_yelt, chosen.select("layer_id", "loss_view", "loss_analysis_id"))


def _counted(t):
    return _chosen_entries(t).groupBy("loss_view", "loss_analysis_id", "layer_id").agg(F.count("*").alias("entries"))


@query("retro_layer_yelts", f"WITH {ENTRIES} SELECT r.retro_program_id, r.layer_id, n.loss_view, n.loss_analysis_id, n.entries FROM {RETRO} r JOIN counted n ON n.layer_id = r.layer_id")
def retro_layer_yelts(t):
    """The loss tables of the layers ceded to each program: of the chosen analysis of each view."""
    return y.retro_layers(t).drop("row_version").join(_counted(t), "layer_id").select("retro_program_id", "layer_id", "loss_view", "loss_analysis_id", "entries")


@query("portfolio_layer_yelts", f"WITH {ENTRIES} SELECT DISTINCT k.retro_program_id, p.portfolio_id, p.layer_id, n.loss_view, n.loss_analysis_id, n.entries FROM port_layer_cession k JOIN port_layer p USING (port_layer_id) JOIN counted n ON n.layer_id = p.layer_id")
def portfolio_layer_yelts(t):
    layers = y.portfolio_retro_layers(t).select("retro_program_id", "portfolio_id", "layer_id").distinct()
    return layers.join(_counted(t), "layer_id").select("retro_program_id", "portfolio_id", "layer_id", "loss_view", "loss_analysis_id", "entries")


@query("analysis_store", f"WITH {ENTRIES} SELECT loss_view, loss_analysis_id, layer_id, {YELT_KEY}, loss_pct FROM entries")
def analysis_store(t):
    """The chosen analyses' entries, read from a store of all analyses of which only the slices with some of them are opened."""
    spark = t.layer_analysis_yelt.sparkSession
    path = temporary(spark, "analyses")
    sinks.write_analyses(t.layer_analysis_yelt, path)
    chosen = y.projected_analyses(t.layer_loss_analysis.select("layer_id", "loss_view", "loss_analysis_id", "row_version"))
    rows = sinks.read_analyses(spark, path, chosen.withColumnRenamed("layer_id", "own_layer")).where("layer_id = own_layer")
    return rows.select("loss_view", "loss_analysis_id", "layer_id", *y.KEY, "loss_pct")


@query("program_day_ranges", f"WITH {PERIODS} SELECT layer_id, retro_program_id, CAST(first_day AS INT) AS first_day, CAST(last_day AS INT) AS last_day FROM ranges")
def program_day_ranges(t):
    """The days on which each program covers each layer: two ranges where the period crosses a year's end."""
    return intervals.day_ranges(y.program_periods(t), "start", "end").select("layer_id", "retro_program_id", "first_day", "last_day")


@query("retro_event_losses", f"""WITH {ENTRIES}, {PERIODS} SELECT r.retro_program_id, e.loss_view, {YELT_KEY}, ROUND(SUM(e.loss_pct * r.cession), 7) AS loss FROM entries e JOIN ranges r ON r.layer_id = e.layer_id AND e.day BETWEEN r.first_day AND r.last_day GROUP BY ALL""")
def retro_event_losses(t):
    """Event losses of all programs and views: entries of the chosen analyses on the days on which a program covers their layer."""
    return rounded(y.program_losses(_chosen_entries(t), y.program_periods(t), ["loss_view"]), "loss")


@query("layer_only_perils", "SELECT DISTINCT layer_id, peril_id FROM layer_yelt EXCEPT SELECT l.layer_id, g.peril_id FROM layer l JOIN gu_yelt_entry g ON g.gu_analysis_id = l.layer_id % 1000")
def layer_only_perils(t):
    own = t.layer.select("layer_id", (F.col("layer_id") % 1000).alias("gu_analysis_id")).join(t.gu_yelt_entry.select("gu_analysis_id", "peril_id").distinct(), "gu_analysis_id")
    return t.layer_yelt.select("layer_id", "peril_id").subtract(own.select("layer_id", "peril_id"))


@query("selected_layers", "SELECT layer_id FROM retro_allocation INTERSECT SELECT layer_id FROM layer_yelt WHERE loss_type = 2")
def selected_layers(t):
    return t.retro_allocation.select("layer_id").intersect(t.layer_yelt.where("loss_type = 2").select("layer_id"))


# --- graphs ---------------------------------------------------------------------------------------------------------
@query("connected_components", """WITH RECURSIVE g AS (SELECT layer_id AS v, px_layer_id AS w FROM px_section UNION SELECT px_layer_id, layer_id FROM px_section), r AS (SELECT v, v AS w FROM g UNION SELECT r.v, g.w FROM r JOIN g ON g.v = r.w)
    SELECT v AS vertex, MIN(w) AS component FROM r GROUP BY v""")
def connected_components(t):
    return graph.connected_components(t.px_section, "layer_id", "px_layer_id")


@query("px_adjacency", "SELECT layer_id, string_agg(CAST(px_layer_id AS VARCHAR), ',' ORDER BY px_layer_id) AS px_layers FROM (SELECT DISTINCT layer_id, px_layer_id FROM px_section) GROUP BY layer_id")
def px_adjacency(t):
    """The layers that each layer is a section of; a layer is one of few."""
    return t.px_section.groupBy("layer_id").agg(F.array_join(F.array_sort(F.collect_set("px_layer_id")).cast("array<string>"), ",").alias("px_layers"))


@query("topological_depth", """WITH RECURSIVE r AS (SELECT v, 0 AS depth FROM (SELECT layer_id AS v FROM px_section UNION SELECT px_layer_id FROM px_section) UNION SELECT p.px_layer_id, r.depth + 1 FROM r JOIN px_section p ON p.layer_id = r.v)
    SELECT v AS vertex, CAST(MAX(depth) AS INT) AS depth FROM r GROUP BY v""")
def topological_depth(t):
    return graph.topological_depth(t.px_section, "layer_id", "px_layer_id")


# --- layering (own specification) -----------------------------------------------------------------------------------
ENGINE = """o AS (SELECT e.layer_id, e.year, e.day, e.peril_id, e.event_id, LEAST(GREATEST(e.loss_pct * l.occ_limit * 3 - l.occ_retention, 0.0), l.occ_limit) AS occ, l.agg_retention AS ret, l.agg_limit AS lim, l.premium, l.occ_limit FROM layer_yelt e JOIN layer l ON l.layer_id = e.layer_id {0}),
    s AS (SELECT *, SUM(occ) OVER (PARTITION BY layer_id, year ORDER BY day, peril_id, event_id ROWS UNBOUNDED PRECEDING) AS run FROM o),
    f AS (SELECT *, LEAST(GREATEST(run - ret, 0.0), lim) - LEAST(GREATEST(run - occ - ret, 0.0), lim) AS layer_loss FROM s)"""


def _layered(t, keep=None):
    terms = t.layer.select("layer_id", "occ_limit", "occ_retention", "agg_limit", "agg_retention", "premium", "inception", "expiration")
    met = t.layer_yelt.join(terms if keep is None else keep(terms), "layer_id")
    met = met.withColumn("occ", layering.occurrence_loss(F.col("loss_pct") * F.col("occ_limit") * 3, F.col("occ_retention"), F.col("occ_limit")))
    return layering.aggregate_losses(met, ["layer_id", "year"], ["day", "peril_id", "event_id"], "occ", "agg_retention", "agg_limit")


@query("layer_losses", f"WITH {ENGINE.format('')} SELECT layer_id, year, day, peril_id, event_id, ROUND(layer_loss, 4) + 0 AS layer_loss, ROUND(layer_loss / occ_limit * premium, 4) + 0 AS reinst_premium FROM f")
def layer_losses(t):
    priced = layering.reinstatement_premium(_layered(t).withColumn("share", F.lit(1.0)), "layer_loss", "occ_limit", "premium", "share")
    return rounded(priced.select("layer_id", "year", "day", "peril_id", "event_id", "layer_loss", "reinst_premium"), "layer_loss", "reinst_premium", digits=4)


DEPTHS = 4  # of the fixtures' graph
CUTOFF = "1997-06-30"
VIEWS = ", ".join(map(str, x.LOSS_VIEWS))
DEC = lambda value: f"CAST({value} AS DECIMAL(20,8))"


def _conditional_sql(eroded: bool, layer_loss: str, out: str) -> str:
    """The run as common table expressions (layers that fit ``layer_loss`` take their own table), and ``out`` from them."""
    steps = []
    for d in range(DEPTHS):
        fed = "".join(
            f" UNION ALL SELECT loss_view, p.px_layer_id, {YELT_KEY}, occ FROM o{k} JOIN (SELECT DISTINCT layer_id, px_layer_id FROM px_section) p USING (layer_id) JOIN depths q ON q.v = p.px_layer_id WHERE q.depth = {d}"
            for k in range(d)
        )
        steps.append(f"""o{d} AS MATERIALIZED (SELECT loss_view, layer_id, {YELT_KEY}, {DEC("LEAST(GREATEST(loss - occ_retention, 0), occ_limit)")} AS occ
        FROM (SELECT loss_view, layer_id, {YELT_KEY}, SUM(loss) AS loss FROM (SELECT loss_view, g.layer_id, {YELT_KEY}, loss FROM g LEFT JOIN depths q ON q.v = g.layer_id WHERE COALESCE(q.depth, 0) = {d}{fed}) GROUP BY ALL) JOIN terms USING (layer_id))""")
    basis = lambda k: DEC(f"CASE WHEN limit_basis = 1 THEN agg_{k} WHEN limit_basis IN (4, 7) THEN risk_{k} ELSE occ_{k} END")
    erosion = DEC("COALESCE(recorded, 0)") if eroded else "0"
    start = f"GREATEST(DATE '{CUTOFF}', inception)" if eroded else "inception"
    every = " UNION ALL ".join(f"SELECT * FROM o{d}" for d in range(DEPTHS))
    first = "CAST(date_trunc('year', from_date) AS DATE)"
    return f"""WITH RECURSIVE walk AS (SELECT v, 0 AS depth FROM (SELECT layer_id AS v FROM px_section UNION SELECT px_layer_id FROM px_section) UNION SELECT p.px_layer_id, r.depth + 1 FROM walk r JOIN px_section p ON p.layer_id = r.v),
    depths AS MATERIALIZED (SELECT v, MAX(depth) AS depth FROM walk GROUP BY v),
    terms AS MATERIALIZED (SELECT layer_id, status, {start} AS from_date, expiration, {basis("limit")} AS occ_limit, {basis("retention")} AS occ_retention, recorded,
        {DEC(f"GREATEST({DEC('agg_limit')} - {erosion}, 0)")} AS limit_left, CASE WHEN {erosion} > 0 THEN 0 ELSE {DEC("agg_retention")} END AS agg_retention
        FROM layer LEFT JOIN (SELECT layer_id, {DEC("SUM(loss_ult) * 100")} AS recorded FROM qtd WHERE rc = 1 GROUP BY 1) e USING (layer_id)),
    chosen AS MATERIALIZED (SELECT loss_view, layer_id, loss_analysis_id, own_gu_analysis_id AS gu_id, layer_id IN (SELECT layer_id FROM layer WHERE {layer_loss}) AS own_loss
        FROM layer_loss_analysis WHERE loss_view IN ({VIEWS}) QUALIFY ROW_NUMBER() OVER (PARTITION BY layer_id, loss_view ORDER BY row_version DESC) = 1),
    g AS MATERIALIZED (SELECT c.loss_view, l.layer_id, {YELT_KEY}, {scans.LOADED_WITH_LAE} AS loss FROM ({scans.loaded(f"loss_view IN ({VIEWS})")}) l JOIN chosen c ON c.loss_analysis_id = l.loss_analysis_id WHERE NOT own_loss),
    {", ".join(steps)},
    e AS MATERIALIZED (SELECT c.*, {", ".join("y." + k for k in YELT_KEY.split(", "))}, loss_pct FROM layer_analysis_yelt y JOIN chosen c ON c.loss_analysis_id = y.loss_analysis_id AND c.layer_id = y.layer_id),
    u AS MATERIALIZED (SELECT * FROM e WHERE NOT own_loss AND NOT EXISTS (SELECT 1 FROM (SELECT DISTINCT gu_analysis_id, peril_id FROM gu_yelt_entry) p WHERE p.gu_analysis_id = e.gu_id AND p.peril_id = e.peril_id)),
    a AS (SELECT loss_view, layer_id, {YELT_KEY}, {DEC("SUM(occ)")} AS occ FROM ({every} UNION ALL SELECT loss_view, layer_id, {YELT_KEY}, {DEC(f"{DEC('loss_pct')} * occ_limit")} AS occ FROM (SELECT * FROM u UNION ALL SELECT * FROM e WHERE own_loss) JOIN terms USING (layer_id)) GROUP BY ALL),
    d AS (SELECT a.*, c.loss_analysis_id, CASE WHEN own_loss THEN 0 ELSE agg_retention END AS ret, limit_left AS lim, expiration,
        CASE WHEN {first} + day - 1 >= from_date THEN {first} + day - 1 ELSE CAST({first} + INTERVAL 1 YEAR AS DATE) + day - 1 END AS event_date
        FROM a JOIN chosen c ON c.loss_view = a.loss_view AND c.layer_id = a.layer_id JOIN terms t ON t.layer_id = a.layer_id WHERE from_date <= expiration AND limit_left > 0),
    s AS (SELECT *, SUM(occ) OVER (PARTITION BY loss_view, layer_id, year ORDER BY event_date, peril_id, event_id ROWS UNBOUNDED PRECEDING) AS run FROM d WHERE event_date <= expiration),
    f AS MATERIALIZED (SELECT * FROM (SELECT *, LEAST(GREATEST(run - ret, 0), lim) - LEAST(GREATEST(run - occ - ret, 0), lim) AS layer_loss FROM s) WHERE layer_loss > 0)
    {out}"""


CONDITIONAL_OUT = f"SELECT loss_view, layer_id, loss_analysis_id, {YELT_KEY}, event_date, CAST(ROUND(layer_loss, 4) AS DOUBLE) AS layer_loss FROM f"
#: Layers that take their own loss table: non-cat quota shares, which have no ground-up events behind them.
LAYER_LOSS = "limit_basis = 7"


def _conditional(run):
    return run.losses.select("loss_view", "layer_id", "loss_analysis_id", *y.KEY, "event_date", F.col("rounded_loss").alias("layer_loss"))


@query("conditional_yelt", _conditional_sql(True, "FALSE", CONDITIONAL_OUT))
def conditional_yelt(t):
    """From the cutoff on, with erosion by the recorded losses; every loss view."""
    return _conditional(conditional.conditional_run(t, CUTOFF, True))


@query("conditional_yelt_uneroded", _conditional_sql(False, "FALSE", CONDITIONAL_OUT))
def conditional_yelt_uneroded(t):
    """The whole periods of the layers, with full limits."""
    return _conditional(conditional.conditional_run(t, CUTOFF, False))


@query("conditional_layer_losses", _conditional_sql(True, LAYER_LOSS, CONDITIONAL_OUT))
def conditional_layer_losses(t):
    """As ``conditional_yelt``, but layers without ground-up events take their own loss tables."""
    return _conditional(conditional.conditional_run(t, CUTOFF, True, by_layer_loss=t.layer.where(LAYER_LOSS)))


RECONCILED = f"""SELECT c.loss_view, c.layer_id, COALESCE(CAST(x.s AS DOUBLE), 0) AS sum_before, COALESCE(x.n, 0) AS n_before,
        COALESCE(CAST(z.s / occ_limit AS DOUBLE), 0) AS sum_after, COALESCE(z.n, 0) AS n_after, ABS(COALESCE(CAST(x.s AS DOUBLE), 0) - COALESCE(z.s / occ_limit, 0)) > 0.01 AS warn
    FROM chosen c JOIN terms t ON t.layer_id = c.layer_id LEFT JOIN (SELECT loss_view, layer_id, SUM({DEC("loss_pct")}) AS s, COUNT(*) AS n FROM e GROUP BY ALL) x ON x.loss_view = c.loss_view AND x.layer_id = c.layer_id
    LEFT JOIN (SELECT loss_view, layer_id, CAST(SUM(layer_loss) AS DOUBLE) AS s, COUNT(*) AS n FROM f GROUP BY ALL) z ON z.loss_view = c.loss_view AND z.layer_id = c.layer_id WHERE occ_limit > 0"""


@query("yelt_reconciliation", _conditional_sql(False, "FALSE", f"SELECT loss_view, layer_id, ROUND(sum_before, 6) AS sum_before, n_before, ROUND(sum_after, 6) AS sum_after, n_after, warn FROM ({RECONCILED})"))
def yelt_reconciliation(t):
    """Counts and sums of each chosen analysis's own losses against those recalculated from ground up, as shares of the limit."""
    run = conditional.conditional_run(t, CUTOFF, False)
    return rounded(run.reconciliation, "sum_before", "sum_after", digits=6)


LOG_OUT = f"""SELECT loss_view, layer_id, CAST(place AS INT) AS place, level, message FROM (
    SELECT v.loss_view, t.layer_id, 1 AS place, 'Warning' AS level, 'no analysis; status ' || status || '; ' || CASE WHEN recorded IS NULL THEN 'no loss recorded' ELSE 'recorded loss ' || CAST(recorded AS DECIMAL(20,2)) END AS message
        FROM terms t, (SELECT CAST(unnest([{VIEWS}]) AS INT) AS loss_view) v WHERE NOT EXISTS (SELECT 1 FROM chosen c WHERE c.layer_id = t.layer_id AND c.loss_view = v.loss_view)
    UNION ALL SELECT loss_view, layer_id, 2, 'Information', 'layer losses taken for perils ' || array_to_string(list_sort(list(DISTINCT peril_id)), ',') FROM u GROUP BY loss_view, layer_id
    UNION ALL SELECT loss_view, layer_id, 3, 'Warning', 'no period in force from ' || from_date || ' to ' || expiration FROM chosen JOIN terms USING (layer_id) WHERE from_date > expiration
    UNION ALL SELECT loss_view, layer_id, 4, 'Warning', 'limit exhausted' FROM chosen JOIN terms USING (layer_id) WHERE from_date <= expiration AND limit_left = 0
    UNION ALL SELECT loss_view, layer_id, 5, CASE WHEN ABS(sum_before - sum_after) > 0.01 THEN 'Warning' ELSE 'Information' END, 'sum of losses ' || sum_before || ' before, ' || sum_after || ' after; entries ' || n_before || ', ' || n_after FROM (
        SELECT c.loss_view, c.layer_id, COALESCE(CAST(x.s AS DECIMAL(20,6)), 0) AS sum_before, COALESCE(CASE WHEN occ_limit = 0 THEN 0 ELSE CAST(CAST(z.s AS DOUBLE) / CAST(occ_limit AS DOUBLE) AS DECIMAL(20,6)) END, 0) AS sum_after, COALESCE(x.n, 0) AS n_before, COALESCE(z.n, 0) AS n_after
        FROM chosen c JOIN terms t ON t.layer_id = c.layer_id LEFT JOIN (SELECT loss_view, layer_id, SUM({DEC("loss_pct")}) AS s, COUNT(*) AS n FROM e GROUP BY ALL) x ON x.loss_view = c.loss_view AND x.layer_id = c.layer_id
        LEFT JOIN (SELECT loss_view, layer_id, SUM(layer_loss) AS s, COUNT(*) AS n FROM f GROUP BY ALL) z ON z.loss_view = c.loss_view AND z.layer_id = c.layer_id WHERE from_date <= expiration AND limit_left > 0))"""


@query("simulation_log", _conditional_sql(True, LAYER_LOSS, LOG_OUT))
def simulation_log(t):
    """What a conditional run skipped, filled in and found different: missing analyses, perils without ground-up losses, periods
    that have ended, limits used up, and sums of losses before and after."""
    return conditional.conditional_run(t, CUTOFF, True, by_layer_loss=t.layer.where(LAYER_LOSS)).log


SCENARIO_MONEY = lambda x: f"CAST({x} AS DECIMAL(20,8))"
SCENARIO_SHARE = lambda value: f"CAST({value} AS DECIMAL(16,10))"
SCENARIO_TERM = lambda k: SCENARIO_MONEY(f"CASE WHEN limit_basis = 1 THEN agg_{k} WHEN limit_basis IN (4, 7) THEN risk_{k} ELSE occ_{k} END / e.fx_rate_to_layer_currency")


SCENARIO_EVENTS = f"""o AS (SELECT e.scenario_id, e.layer_id, e.event_key, e.event_date, {SCENARIO_MONEY(f"LEAST(GREATEST({SCENARIO_MONEY('e.gu_loss')} - {SCENARIO_TERM('retention')}, 0), {SCENARIO_TERM('limit')})")} AS occ, {SCENARIO_TERM('limit')} AS lim,
        {SCENARIO_MONEY("agg_retention / e.fx_rate_to_layer_currency")} AS agg_ret, {SCENARIO_MONEY("agg_limit / e.fx_rate_to_layer_currency")} AS agg_lim, premium
        FROM scenario_loss_event e JOIN scenario s USING (scenario_id) JOIN layer l ON l.layer_id = e.layer_id WHERE s.is_active AND NOT s.is_deleted AND e.loss_currency = 'USD' AND e.event_date BETWEEN DATE '2024-01-01' AND DATE '2024-01-20'),
    t AS (SELECT scenario_id, layer_id, MAX(lim) AS lim, MAX(agg_ret) AS ret, MAX(agg_lim) AS top FROM o GROUP BY 1, 2),
    r AS (SELECT o.scenario_id, o.layer_id, event_key, occ, t.lim, ret, top, premium, SUM(occ) OVER (PARTITION BY o.scenario_id, o.layer_id ORDER BY event_date, event_key ROWS UNBOUNDED PRECEDING) AS run FROM o JOIN t ON t.scenario_id = o.scenario_id AND t.layer_id = o.layer_id),
    u AS MATERIALIZED (SELECT *, LEAST(GREATEST(run - occ - ret, 0), top) AS used_before, LEAST(GREATEST(run - ret, 0), top) AS used_after FROM r),
    b AS (SELECT layer_id, premium_share, brokerage_percentage, quantity, ROW_NUMBER() OVER w AS band, SUM(quantity) OVER w AS upto FROM reinstatement WHERE quantity > 0 WINDOW w AS (PARTITION BY layer_id ORDER BY reinstatement_order, reinstatement_id ROWS UNBOUNDED PRECEDING)),
    q AS (SELECT u.*, band, premium_share, brokerage_percentage, LEAST({SCENARIO_SHARE("CAST(used_after AS DOUBLE) / CAST(lim AS DOUBLE)")}, {SCENARIO_SHARE("upto")}) - GREATEST({SCENARIO_SHARE("CAST(used_before AS DOUBLE) / CAST(lim AS DOUBLE)")}, {SCENARIO_SHARE("upto - quantity")}) AS times FROM u JOIN b ON b.layer_id = u.layer_id WHERE lim > 0),
    p AS MATERIALIZED (SELECT scenario_id, layer_id, event_key, band, rp, {SCENARIO_MONEY(f"rp * {SCENARIO_SHARE('brokerage_percentage')}")} AS rb FROM (SELECT *, {SCENARIO_MONEY(f"{SCENARIO_MONEY('premium * ' + SCENARIO_SHARE('premium_share'))} * {SCENARIO_SHARE('times')}")} AS rp FROM q WHERE times > 0))"""


def _scenario_events(t):
    met = t.scenario_loss_event.where((F.col("loss_currency") == "USD") & F.col("event_date").between("2024-01-01", "2024-01-20"))
    return met.join(t.scenario.where("is_active AND NOT is_deleted").select("scenario_id"), "scenario_id").join(t.layer, "layer_id")


@query("scenario_loss_aggregate", f"""WITH {SCENARIO_EVENTS}, a AS (SELECT scenario_id, layer_id, COUNT(*) AS events, SUM(used_after - used_before) AS loss FROM u GROUP BY 1, 2), s AS (SELECT scenario_id, layer_id, SUM(rp) AS rp, SUM(rb) AS rb FROM p GROUP BY 1, 2)
    SELECT a.scenario_id, a.layer_id, events, CAST(ROUND(loss, 4) AS DOUBLE) AS loss, CAST(ROUND(COALESCE(rp, 0), 4) AS DOUBLE) AS reinst_premium, CAST(ROUND(COALESCE(rb, 0), 4) AS DOUBLE) AS brokerage FROM a LEFT JOIN s ON s.scenario_id = a.scenario_id AND s.layer_id = a.layer_id""")
def scenario_loss_aggregate(t):
    """Losses of each active scenario and layer under occurrence and aggregate terms in the loss currency, and what the
    reinstatements cost that they use, each at its own share of the premium."""
    return exact(layering.scenario_losses(_scenario_events(t), t.reinstatement), "loss", "reinst_premium", "brokerage", digits=4)


@query("scenario_reinstatement_premiums", f"WITH {SCENARIO_EVENTS} SELECT scenario_id, layer_id, event_key, CAST(band AS INT) AS band, CAST(ROUND(rp, 4) AS DOUBLE) AS reinst_premium, CAST(ROUND(rb, 4) AS DOUBLE) AS brokerage FROM p")
def scenario_reinstatement_premiums(t):
    """Which reinstatements each event of a scenario uses, and what they cost."""
    paid = layering.reinstated(layering.scenario_event_losses(_scenario_events(t)), layering.reinstatement_bands(t.reinstatement), ["scenario_id", "layer_id", "event_key"])
    return exact(paid, "reinst_premium", "brokerage", digits=4)


@query("scenario_retro_cessions", """WITH l AS (SELECT scenario_id, retro_program_id, COUNT(*) AS events, SUM(COALESCE(loss, 0)) AS loss FROM scenario_retro_cession_loss GROUP BY 1, 2)
    SELECT c.scenario_id, c.retro_program_id, c.level, c.name, c.cession, COALESCE(events, 0) AS events, ROUND(COALESCE(loss, 0), 4) AS loss FROM scenario_retro_cession c LEFT JOIN l ON l.scenario_id = c.scenario_id AND l.retro_program_id = c.retro_program_id""")
def scenario_retro_cessions(t):
    """The cessions of scenarios to programs, with the number and sum of the losses ceded."""
    key = ["scenario_id", "retro_program_id"]
    losses = t.scenario_retro_cession_loss.groupBy(*key).agg(F.count("*").alias("events"), F.sum(F.coalesce("loss", F.lit(0.0))).alias("loss"))
    out = t.scenario_retro_cession.join(losses, key, "left").fillna(0, ["events", "loss"])
    return rounded(out.select(*key, "level", "name", "cession", "events", "loss"), "loss", digits=4)


@query("scenario_reinstatements", "SELECT DISTINCT e.scenario_id, r.layer_id, r.reinstatement_id, r.reinstatement_order, r.quantity, r.premium_share FROM scenario_loss_event e JOIN reinstatement r ON r.layer_id = e.layer_id WHERE r.quantity > 0")
def scenario_reinstatements(t):
    return t.scenario_loss_event.select("scenario_id", "layer_id").distinct().join(t.reinstatement.where("quantity > 0"), "layer_id").select("scenario_id", "layer_id", "reinstatement_id", "reinstatement_order", "quantity", "premium_share")
