"""Scans, filters and projections."""

from __future__ import annotations

from pyspark.sql import functions as F

from inuring.functions import terms as x
from inuring.operators import conditional
from inuring.operators import yelt as y
from inuring.plans.registry import query
from inuring.functions.terms import PERILS
from inuring.sources import contracts, sinks
from inuring.sources.shared import temporary
from inuring.sources.tables import Tables
from inuring.streaming import cdc

ACTIVE = "is_active AND NOT is_deleted"
MARK = 7000


@query("scan_layers", f"SELECT layer_id, inception, expiration FROM layer WHERE {ACTIVE}")
def scan_layers(t):
    return t.layer.where(ACTIVE).select("layer_id", "inception", "expiration")


@query("scan_layer_details", f"SELECT * EXCLUDE (is_active, is_deleted) FROM layer WHERE {ACTIVE}")
def scan_layer_details(t):
    return t.layer.where(ACTIVE).drop("is_active", "is_deleted")


@query("layer_meta_infos", f"SELECT layer_id, segment FROM layer WHERE {ACTIVE}")
def layer_meta_infos(t):
    return t.layer.where(ACTIVE).select("layer_id", "segment")


@query("layer_reinstatements", "SELECT * FROM reinstatement")
def layer_reinstatements(t):
    return t.reinstatement


@query("layer_top_up_zones", f"SELECT layer_id, top_up_zone_id FROM layer WHERE {ACTIVE} AND top_up_zone_id IS NOT NULL")
def layer_top_up_zones(t):
    return t.layer.where(ACTIVE).where("top_up_zone_id is not null").select("layer_id", "top_up_zone_id")


def _scan(name: str) -> None:
    query(f"scan_{name}s", f"SELECT * FROM {name}")(lambda t: getattr(t, name))


for _name in ("submission", "retro_investor_reset", "retro_program_reset", "sp_insurer", "retro_investor", "retro_zone", "retro_profile", "portfolio", "port_layer", "retro_allocation", "fx_rate", "px_section"):
    _scan(_name)
query("scan_submission_gu_analyses", "SELECT * FROM submission_gu_analysis")(lambda t: t.submission_gu_analysis)


@query("scan_retro_programs", "SELECT retro_program_id, retro_profile_id, inception, expiration, retro_program_type, CAST(stored_level + 1 AS INT) AS retro_level FROM retro_program")
def scan_retro_programs(t):
    return t.retro_program.withColumn("retro_level", F.col("stored_level") + 1).drop("stored_level", "row_version")


RETRO_LAYERS = "SELECT layer_id, retro_program_id, MAX(retro_allocation.row_version) AS row_version FROM retro_allocation JOIN retro_investor USING (retro_investor_id) JOIN sp_insurer USING (sp_insurer_id) GROUP BY layer_id, retro_program_id"


@query("retro_layers", RETRO_LAYERS)
def retro_layers(t):
    return y.retro_layers(t)


@query("retro_layers_incremental", f"{RETRO_LAYERS} HAVING MAX(retro_allocation.row_version) > {MARK}")
def retro_layers_incremental(t):
    return cdc.since(y.retro_layers(t), MARK)


@query("portfolio_retro_layers", "SELECT DISTINCT layer_id, retro_program_id, port_layer_id, portfolio_id FROM port_layer_cession JOIN port_layer USING (port_layer_id)")
def portfolio_retro_layers(t):
    return y.portfolio_retro_layers(t)


@query("portfolio_retro_layers_incremental", f"SELECT DISTINCT layer_id, retro_program_id, port_layer_id, portfolio_id FROM port_layer_cession JOIN port_layer USING (port_layer_id) WHERE row_version > {MARK}")
def portfolio_retro_layers_incremental(t):
    return y.portfolio_retro_layers(t, MARK)


@query("allocations_for_programs", "SELECT a.* FROM retro_allocation a JOIN retro_investor USING (retro_investor_id) JOIN sp_insurer USING (sp_insurer_id) WHERE retro_program_id IN (3, 5, 8)")
def allocations_for_programs(t):
    wanted = t.retro_investor.join(t.sp_insurer, "sp_insurer_id").where(F.col("retro_program_id").isin(3, 5, 8)).select("retro_investor_id")
    return t.retro_allocation.join(wanted, "retro_investor_id", "left_semi")


@query("semi_join_retros", "SELECT * FROM retro_allocation WHERE retro_investor_id IN (SELECT retro_investor_id FROM retro_investor WHERE target_collateral = 0)")
def semi_join_retros(t):
    return t.retro_allocation.join(t.retro_investor.where("target_collateral = 0").select("retro_investor_id"), "retro_investor_id", "left_semi")


@query("portlayer_cessions", "SELECT port_layer_cession_id, port_layer_id, retro_program_id, cession_gross, CAST(port_layer_cession_id % 8 AS INT) AS part FROM port_layer_cession WHERE cession_gross > 0 AND should_cession_apply")
def portlayer_cessions(t):
    kept = t.port_layer_cession.where("cession_gross > 0 AND should_cession_apply").drop("should_cession_apply", "row_version")
    return kept.withColumn("part", F.pmod("port_layer_cession_id", F.lit(8)).cast("int"))


@query("loss_analyses", "SELECT loss_analysis_id, layer_id, loss_view, row_version FROM layer_loss_analysis JOIN layer USING (layer_id) WHERE loss_view IN (1, 10, 3, 30, 4)".replace("row_version FROM", "layer_loss_analysis.row_version FROM"))
def loss_analyses(t):
    return y.selected_views(t.layer_loss_analysis).join(t.layer.select("layer_id"), "layer_id").select("loss_analysis_id", "layer_id", "loss_view", "row_version")


@query("loss_analyses_extended", "SELECT loss_analysis_id, layer_id, loss_view, row_version, COALESCE(gu_analysis_id, own_gu_analysis_id) AS gu_analysis_id, * EXCLUDE (loss_analysis_id, layer_id, loss_view, row_version, gu_analysis_id, own_gu_analysis_id) FROM layer_loss_analysis WHERE loss_view IN (1, 10, 3, 30, 4)")
def loss_analyses_extended(t):
    return y.selected_views(t.layer_loss_analysis).withColumn("gu_analysis_id", F.coalesce("gu_analysis_id", "own_gu_analysis_id")).drop("own_gu_analysis_id")


VERSIONED = ("retro_allocation", "retro_investor", "sp_insurer", "layer", "retro_program", "retro_zone", "retro_investor_reset", "retro_program_reset", "reinstatement", "fx_rate", "layer_loss_analysis")
MARKS = " UNION ALL ".join(f"SELECT '{n}' AS table_name, CAST(COALESCE(MAX(row_version), 0) AS BIGINT) AS row_version FROM {n}" for n in VERSIONED)


@query("latest_row_versions", MARKS)
def latest_row_versions(t):
    return cdc.high_water_marks({n: getattr(t, n) for n in VERSIONED})


OLD_MARKS = " UNION ALL ".join(f"SELECT '{n}' AS table_name, CAST(COALESCE(MAX(row_version), 0) AS BIGINT) AS row_version FROM {n} WHERE row_version <= {MARK}" for n in VERSIONED)


@query("changed_tables", f"SELECT now.* FROM ({MARKS}) now JOIN ({OLD_MARKS}) old USING (table_name) WHERE now.row_version > old.row_version")
def changed_tables(t):
    """Tables with a higher mark than a copy of them has that was taken at a version."""
    copy = cdc.high_water_marks({n: getattr(t, n).where(f"row_version <= {MARK}") for n in VERSIONED})
    return cdc.changed(copy, cdc.high_water_marks({n: getattr(t, n) for n in VERSIONED}))


@query("incremental_pull", f"SELECT * FROM layer_loss_analysis WHERE row_version > {MARK}")
def incremental_pull(t):
    return cdc.since(t.layer_loss_analysis, MARK)


@query("upsert_latest", "SELECT layer_id, loss_view, loss_analysis_id, row_version FROM layer_loss_analysis QUALIFY ROW_NUMBER() OVER (PARTITION BY layer_id, loss_view ORDER BY row_version DESC) = 1")
def upsert_latest(t):
    """What was there at the mark, then what came after it, upserted into a stored table and read from its manifest."""
    rows = t.layer_loss_analysis.select("layer_id", "loss_view", "loss_analysis_id", "row_version")
    state = cdc.VersionedTable(rows.sparkSession, temporary(rows.sparkSession, "state"), ["layer_id", "loss_view"])
    state.apply(rows.where(f"row_version <= {MARK}"), 0)
    state.apply(rows.where(f"row_version > {MARK}"), 1)
    return state.read()


@query("yelt_modelled", "SELECT layer_id, year, day, peril_id, event_id, loss_pct, rp FROM layer_yelt WHERE loss_type = 1")
def yelt_modelled(t):
    return t.layer_yelt.where("loss_type = 1").drop("loss_type")


@query("yelt_all", "SELECT * FROM layer_yelt")
def yelt_all(t):
    return t.layer_yelt


@query("yelt_scan_partitioned", "SELECT CAST(year % 8 AS INT) AS part, COUNT(*) AS entries, CAST(ROUND(SUM(loss_pct), 6) AS DOUBLE) AS loss FROM layer_yelt GROUP BY year % 8")
def yelt_scan_partitioned(t):
    return t.layer_yelt.groupBy(F.pmod("year", F.lit(8)).cast("int").alias("part")).agg(F.count("*").alias("entries"), F.round(F.sum("loss_pct"), 6).alias("loss"))


@query("gu_yelt", "SELECT gu_analysis_id, year, event_id, peril_id, day, CAST(SUM(loss) AS DOUBLE) AS loss FROM gu_yelt_entry GROUP BY ALL")
def gu_yelt(t):
    return y.gu_yelt(t.gu_yelt_entry)


@query("scenario_layers", f"SELECT scenario_id, layer_id, event_date, gu_loss FROM scenario_loss_event JOIN scenario USING (scenario_id) WHERE {ACTIVE}")
def scenario_layers(t):
    return t.scenario_loss_event.join(t.scenario.where(ACTIVE).select("scenario_id"), "scenario_id").select("scenario_id", "layer_id", "event_date", "gu_loss")


@query("scenario_occ_losses", "SELECT scenario_id, layer_id, CAST(ROUND(SUM(gu_loss), 4) AS DOUBLE) AS gu_loss FROM scenario_loss_event WHERE gu_loss <> 0 GROUP BY scenario_id, layer_id")
def scenario_occ_losses(t):
    return t.scenario_loss_event.where("gu_loss <> 0").groupBy("scenario_id", "layer_id").agg(F.round(F.sum("gu_loss"), 4).alias("gu_loss"))


for _name in ("scenario_layer_loss", "scenario_layer_section", "scenario_layer_reinstatement", "scenario_retro_cession", "scenario_retro_cession_loss"):
    _scan(_name)


@query("scenario_layer_losses_nonzero", f"SELECT * FROM scenario_layer_loss WHERE gu_loss <> 0 AND scenario_id IN (SELECT scenario_id FROM scenario WHERE {ACTIVE})")
def scenario_layer_losses_nonzero(t):
    """Layer losses of active scenarios that aren't null or zero."""
    return t.scenario_layer_loss.where("gu_loss <> 0").join(t.scenario.where(ACTIVE).select("scenario_id"), "scenario_id", "left_semi")


def scenario_rows(df, scenarios=None, layers=None):
    """Rows of a scenario table by scenario, by layer, or both, each a list of ids (a filter that reaches the source) or a table of them."""
    for column, wanted in (("scenario_id", scenarios), ("layer_id", layers)):
        if wanted is None:
            continue
        df = df.join(wanted.select(column), column, "left_semi") if hasattr(wanted, "select") else df.where(F.col(column).isin(*wanted))
    return df


@query("scenario_losses_of_scenarios", "SELECT * FROM scenario_layer_loss WHERE scenario_id IN (SELECT scenario_id FROM scenario WHERE run_date = (SELECT MAX(run_date) FROM scenario))")
def scenario_losses_of_scenarios(t):
    """Layer losses of the scenarios of the newest run."""
    newest = t.scenario.agg(F.max("run_date").alias("run_date"))
    return scenario_rows(t.scenario_layer_loss, scenarios=t.scenario.join(F.broadcast(newest), "run_date")).select(t.scenario_layer_loss.columns)


@query("scenario_sections_of_layers", "SELECT * FROM scenario_layer_section WHERE layer_id IN (SELECT layer_id FROM layer WHERE status = 10)")
def scenario_sections_of_layers(t):
    """Sections of bound layers in all scenarios."""
    bound = t.layer.where(F.col("status") == x.BOUND).select(F.col("layer_id").cast("long").alias("layer_id"))
    return scenario_rows(t.scenario_layer_section, layers=bound).select(t.scenario_layer_section.columns)


@query("scenario_reinstatements_of_both", "SELECT * FROM scenario_layer_reinstatement WHERE layer_id IN (SELECT layer_id FROM layer WHERE status = 10) AND scenario_id IN (SELECT scenario_id FROM scenario WHERE is_active AND NOT is_deleted)")
def scenario_reinstatements_of_both(t):
    """Reinstatements of bound layers in active scenarios."""
    bound = t.layer.where(F.col("status") == x.BOUND).select(F.col("layer_id").cast("long").alias("layer_id"))
    return scenario_rows(t.scenario_layer_reinstatement, t.scenario.where(ACTIVE), bound).select(t.scenario_layer_reinstatement.columns)


@query("scenario_retro_losses", "SELECT scenario_id, retro_program_id, l.event_key, CAST(CAST(CAST(l.loss AS DECIMAL(20,8)) * CAST(c.cession AS DECIMAL(16,10)) AS DECIMAL(20,8)) AS DOUBLE) AS ceded_loss FROM scenario_retro_cession_loss l JOIN scenario_retro_cession c USING (scenario_id, retro_program_id) WHERE l.loss IS NOT NULL")
def scenario_retro_losses(t):
    """Retro losses of scenarios with the program's cession applied."""
    met = t.scenario_retro_cession_loss.where("loss IS NOT NULL").join(t.scenario_retro_cession, ["scenario_id", "retro_program_id"])
    return met.select("scenario_id", "retro_program_id", "event_key", x.times(F.col("loss").cast(x.MONEY), F.col("cession")).cast("double").alias("ceded_loss"))


ITD = """SELECT q.master_key, q.master_key_from, l.layer_id, l.submission_id, s.is_multiyear, s.is_cancellable, q.uw_year{0}, g.segment, q.perspective_id, q.currency, q.facility,
    CAST(SUM(wp) AS DOUBLE) AS wp, CAST(SUM(wp - rip) AS DOUBLE) AS wpxrp, CAST(SUM(rip) AS DOUBLE) AS rp, CAST(SUM(ep) AS DOUBLE) AS ep, CAST(SUM(loss_ult) AS DOUBLE) AS ult_loss
    FROM qtd q JOIN facility_segment g ON g.facility = q.facility JOIN layer l ON l.regis_mkey = q.master_key AND l.regis_mkey <> '' JOIN submission s ON s.submission_id = l.submission_id
    WHERE l.layer_id IN (SELECT layer_id FROM retro_allocation WHERE cession_gross > 0) AND rc = 1 AND q.currency = 'USD' AND acct_period <= 199912 AND perspective_id IN (1, 2) GROUP BY ALL"""
ITD_PERIOD = 199912


def itd(t: Tables, period: int = ITD_PERIOD, programs: list[int] | None = None, by_period: bool = False):
    """Premiums and losses up to an accounting period of the layers ceded to the programs (all, or some), found by their master keys;
    with ``by_period`` for each period. Segments are those of the facility; one with several counts in each. Layers without a master key
    have none."""
    ceded = t.retro_allocation.where("cession_gross > 0")
    if programs is not None:
        own = t.sp_insurer.where(F.col("retro_program_id").isin(*programs)).select("sp_insurer_id")
        ceded = ceded.join(t.retro_investor.join(own, "sp_insurer_id", "left_semi").select("retro_investor_id"), "retro_investor_id", "left_semi")
    layers = t.layer.where("regis_mkey <> ''").join(ceded.select("layer_id").distinct(), "layer_id", "left_semi")
    layers = layers.select("layer_id", "submission_id", F.col("regis_mkey").alias("master_key")).join(t.submission.select("submission_id", "is_multiyear", "is_cancellable"), "submission_id")
    kept = t.qtd.where((F.col("rc") == 1) & (F.col("currency") == "USD") & (F.col("acct_period") <= period) & F.col("perspective_id").isin(1, 2)).drop("layer_id")
    kept = kept.join(t.facility_segment.select("facility", "segment").distinct(), "facility").join(layers, "master_key")
    keys = ["master_key", "master_key_from", "layer_id", "submission_id", "is_multiyear", "is_cancellable", "uw_year", *["acct_period"] * by_period, "segment", "perspective_id", "currency", "facility"]
    total = lambda c, n: F.sum(c).cast("double").alias(n)
    return kept.groupBy(*keys).agg(total("wp", "wp"), total(F.col("wp") - F.col("rip"), "wpxrp"), total("rip", "rp"), total("ep", "ep"), total("loss_ult", "ult_loss"))


query("itd_metrics", ITD.format(""))(lambda t: itd(t))
query("itd_quarter_metrics", ITD.format(", q.acct_period"))(lambda t: itd(t, by_period=True))


@query("csv_roundtrip", "SELECT layer_id, segment, occ_limit FROM layer")
def csv_roundtrip(t):
    rows = t.layer.select("layer_id", "segment", "occ_limit")
    path = temporary(rows.sparkSession, "csv")
    sinks.write_csv(rows, path)
    return sinks.read_csv(rows.sparkSession, path, rows.schema)


OWN = "CAST(layer_id % 50 AS INT) AS loss_analysis_id, CAST(1 + layer_id % 3 AS BIGINT) AS row_version"


@query("versioned_yelt", f"SELECT loss_analysis_id, row_version, layer_id, year, day, peril_id, event_id, loss_pct FROM (SELECT *, {OWN} FROM layer_yelt) QUALIFY row_version = MAX(row_version) OVER (PARTITION BY loss_analysis_id)")
def versioned_yelt(t):
    """All layers' entries, as three versions of 50 analyses; superseded ones are archived before the rest is read."""
    rows = t.layer_yelt.withColumns({"loss_analysis_id": F.col("layer_id") % 50, "row_version": 1 + F.col("layer_id") % 3}).select("loss_analysis_id", "row_version", "layer_id", "year", "day", "peril_id", "event_id", "loss_pct")
    spark, path = rows.sparkSession, temporary(rows.sparkSession, "yelt")
    sinks.write_versioned(rows, path)
    sinks.archive_superseded(spark, path, temporary(spark, "archive"))
    return sinks.read_latest(spark, path).select(F.col("loss_analysis_id").cast("int"), F.col("row_version").cast("long"), *rows.columns[2:])


@query("two_layer_round_trip", """SELECT y.layer_id, k.* FROM (SELECT *, ROW_NUMBER() OVER (ORDER BY day, year, peril_id, event_id) - 1 AS place FROM (SELECT DISTINCT day, year, peril_id, event_id FROM layer_yelt WHERE layer_id IN (SELECT layer_id FROM layer ORDER BY 1 LIMIT 2) AND day BETWEEN 2 AND 364)) k
    JOIN (SELECT * FROM layer_yelt WHERE layer_id IN (SELECT layer_id FROM layer ORDER BY 1 LIMIT 2)) y USING (day, year, peril_id, event_id)""")
def two_layer_round_trip(t):
    """The first two layers' tables written as versions, read back, cut to a range of days, merged, and mapped to the merged keys."""
    two = t.layer.select("layer_id").orderBy("layer_id").limit(2)
    rows = t.layer_yelt.join(two, "layer_id", "left_semi").withColumns({"loss_analysis_id": F.col("layer_id"), "row_version": F.lit(1).cast("long")})
    path = temporary(rows.sparkSession, "two")
    sinks.write_versioned(rows, path)
    back = y.day_partition(sinks.read_latest(rows.sparkSession, path), 2, 364)
    return back.select("layer_id", *y.KEY).join(y.event_index(back), y.KEY).select("layer_id", *y.KEY, "place")


@query("idempotent_append", "SELECT layer_id, segment FROM layer")
def idempotent_append(t):
    """A third of the rows loaded, then all, then all again."""
    rows = t.layer.select("layer_id", "segment")
    path = temporary(rows.sparkSession, "load")
    for part in (rows.where("layer_id % 3 = 0"), rows, rows):
        sinks.append_once(part, path, ["layer_id"])
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


@query("appended_runs", "SELECT CAST(CASE status WHEN 10 THEN 1 WHEN 22 THEN 2 ELSE 3 END AS BIGINT) AS run_id, layer_id, status FROM layer")
def appended_runs(t):
    """A run for each status, appended to tables that are made if missing, each under the next id."""
    rows = t.layer.select("layer_id", "status")
    path = temporary(rows.sparkSession, "runs")
    for status in (10, 22, 36):
        sinks.append_run(rows.where(F.col("status") == status), path, f"status {status}")
    return sinks.read_runs(rows.sparkSession, path).select("run_id", "layer_id", "status")


@query("itd_calculation", ITD.format("").replace("SELECT q.master_key,", "SELECT CAST(1 AS BIGINT) AS run_id, q.master_key,"))
def itd_calculation(t):
    """Inception-to-date metrics exported under the id of a new calculation."""
    rows = itd(t)
    path = temporary(rows.sparkSession, "itd")
    sinks.append_run(rows, path, "itd")
    return sinks.read_runs(rows.sparkSession, path).select("run_id", *rows.columns)


@query("allocations_checked", "SELECT a.layer_id, a.retro_investor_id, i.sp_insurer_id FROM retro_allocation a JOIN retro_investor i USING (retro_investor_id)")
def allocations_checked(t):
    """A join that fails if an allocation's investor is missing."""
    return sinks.join_or_fail(t.retro_allocation.select("layer_id", "retro_investor_id"), t.retro_investor.select("retro_investor_id", "sp_insurer_id"), ["retro_investor_id"]).select("layer_id", "retro_investor_id", "sp_insurer_id")


@query("missing_partners", "SELECT submission_id, COUNT(*) AS n FROM (SELECT CAST(layer_id % 101 AS INT) AS submission_id FROM layer) l WHERE NOT EXISTS (SELECT 1 FROM submission s WHERE s.submission_id = l.submission_id) GROUP BY 1")
def missing_partners(t):
    """How many rows would find no partner, by key."""
    return sinks.missing_keys(t.layer.select((F.col("layer_id") % 101).alias("submission_id")), t.submission, ["submission_id"])


@query("yelt_year_major", "SELECT layer_id, ROW_NUMBER() OVER (PARTITION BY layer_id ORDER BY year, day, peril_id, event_id) AS place, year, day, peril_id, event_id FROM layer_yelt")
def yelt_year_major(t):
    return y.year_major(t.layer_yelt, ["layer_id"]).select("layer_id", "place", "year", "day", "peril_id", "event_id")


@query("sorted_day_ranges", "SELECT layer_id, first_day, last_day, CAST(ROW_NUMBER() OVER (PARTITION BY layer_id ORDER BY first_day, last_day) AS INT) AS place FROM (SELECT layer_id, CAST(d * 100 + 1 AS INT) AS first_day, CAST(d * 100 + 1 + layer_id % 100 AS INT) AS last_day FROM layer, (VALUES (2), (0), (1)) v(d))")
def sorted_day_ranges(t):
    three = t.layer.select("layer_id", F.explode(F.array(*[F.lit(d) for d in (2, 0, 1)])).alias("d"))
    return y.checked_ranges(three.selectExpr("layer_id", "d * 100 + 1 AS first_day", "d * 100 + 1 + layer_id % 100 AS last_day"), ["layer_id"])


@query("next_calculation_id", "SELECT CAST(COALESCE(MAX(layer_id), 0) + 1 AS BIGINT) AS next_id FROM layer")
def next_calculation_id(t):
    return sinks.next_id(t.layer, "layer_id")


@query("contract_violations", contracts.violations_sql())
def contract_violations(t):
    """Keys that repeat and references that name nothing, over all tables."""
    return contracts.violations(t)


@query("primary_key_check", "SELECT layer_id, retro_investor_id, cession_gross FROM retro_allocation")
def primary_key_check(t):
    return sinks.unique_or_fail(t.retro_allocation.select("layer_id", "retro_investor_id", "cession_gross"), ["layer_id", "retro_investor_id"])


@query("active_only", f"SELECT scenario_id, run_date FROM scenario WHERE {ACTIVE}")
def active_only(t):
    return t.scenario.where(ACTIVE).select("scenario_id", "run_date")


@query("event_window", "SELECT * FROM scenario_loss_event WHERE event_date BETWEEN DATE '2024-01-02' AND DATE '2024-01-10'")
def event_window(t):
    return t.scenario_loss_event.where(F.col("event_date").between("2024-01-02", "2024-01-10"))


@query("status_filter", "SELECT layer_id, status FROM layer WHERE status IN (10, 22) AND segment IN ('CA', 'PC')")
def status_filter(t):
    return t.layer.where(F.col("status").isin(10, 22) & F.col("segment").isin("CA", "PC")).select("layer_id", "status")


BASIS = "CASE WHEN limit_basis = 1 THEN agg_{0} WHEN limit_basis IN (4, 7) THEN risk_{0} ELSE occ_{0} END"


@query("limit_100pct", f"SELECT layer_id, {BASIS.format('limit')} AS limit_100pct FROM layer")
def limit_100pct(t):
    return t.layer.select("layer_id", x.by_basis(F.col("limit_basis"), F.col("agg_limit"), F.col("risk_limit"), F.col("occ_limit")).alias("limit_100pct"))


@query("occ_retention", f"SELECT layer_id, {BASIS.format('retention')} AS occ_retention FROM layer")
def occ_retention(t):
    return t.layer.select("layer_id", x.by_basis(F.col("limit_basis"), F.col("agg_retention"), F.col("risk_retention"), F.col("occ_retention")).alias("occ_retention"))


@query("deposit_premium", """SELECT layer_id, ROUND(premium * CASE WHEN placement = 0 THEN 0 ELSE 1 / placement END * CASE WHEN signed_share > 0 THEN signed_share ELSE estimated_share END
    * CASE tran_type WHEN 2 THEN -1 WHEN 1 THEN 1 ELSE 0 END, 6) + 0 AS deposit_premium FROM layer JOIN submission USING (submission_id)""")
def deposit_premium(t):
    per = F.when(F.col("placement") == 0, 0.0).otherwise(1 / F.when(F.col("placement") != 0, F.col("placement")))
    value = F.col("premium") * per * x.share(F.col("signed_share"), F.col("estimated_share")) * x.sign(F.col("tran_type"))
    return t.layer.join(t.submission.select("submission_id", "tran_type"), "submission_id").select("layer_id", (F.round(value, 6) + 0).alias("deposit_premium"))


@query("linear_premium", "SELECT layer_id, ROUND(premium * (expiration - DATE '1997-01-01' + 1) / (expiration - inception + 1.0), 6) AS premium FROM layer WHERE inception <= DATE '1997-01-01' AND expiration >= DATE '1997-01-01'")
def linear_premium(t):
    day = F.to_date(F.lit("1997-01-01"))
    met = t.layer.where((F.col("inception") <= day) & (F.col("expiration") >= day))
    return met.select("layer_id", F.round(F.col("premium") * x.days(day, F.col("expiration")) / x.days(F.col("inception"), F.col("expiration")), 6).alias("premium"))


@query("cession_before_placement", "SELECT retro_investor_id, ROUND(CASE WHEN target_collateral = 0 THEN investment_signed ELSE investment_signed_amt / target_collateral END, 9) AS cession FROM retro_investor")
def cession_before_placement(t):
    from inuring.operators.cessions import before_placement

    return t.retro_investor.select("retro_investor_id", F.round(before_placement(F.col("investment_signed_amt"), F.col("target_collateral"), F.col("investment_signed")), 9).alias("cession"))


def _product(*factors: str) -> str:
    out = factors[0]
    for f in factors[1:]:
        out = f"CAST({out} * {f} AS DECIMAL(16,10))"
    return out


ONE = lambda kind, p: f"(1 + CAST({kind}_{p} AS DECIMAL(16,10)))"
WITHOUT = lambda p: _product(f"CAST({ONE('peril', p)} AS DECIMAL(16,10))", *(f"CAST({ONE(k, p)} AS DECIMAL(16,10))" for k in ("growth", "social", "cedent")), "CAST(1 + CAST(inflation AS DECIMAL(16,10)) AS DECIMAL(16,10))")
LOADS = " UNION ALL ".join(f"SELECT loss_analysis_id, CAST({code} AS INT) AS peril_id, {_product(WITHOUT(p), f'CAST({ONE("lae", p)} AS DECIMAL(16,10))')} AS load, {WITHOUT(p)} AS load_x_lae, CAST({ONE('lae', p)} AS DECIMAL(16,10)) AS lae_load FROM layer_loss_analysis" for p, code in PERILS.items())
AS_DOUBLES = ", ".join(f"CAST({n} AS DOUBLE) AS {n}" for n in ("load", "load_x_lae", "lae_load"))


@query("peril_loads", f"SELECT loss_analysis_id, peril_id, {AS_DOUBLES} FROM ({LOADS})")
def peril_loads(t):
    return y.peril_loads(t.layer_loss_analysis).withColumns({n: F.col(n).cast("double") for n in ("load", "load_x_lae", "lae_load")})


MONEY_SQL = lambda a, b: f"CAST({a} * {b} AS DECIMAL(20,8))"


def loaded(where: str) -> str:
    """Loaded ground-up losses of the newest analysis of each layer and view that fits."""
    newest = f"SELECT * FROM layer_loss_analysis WHERE {where} QUALIFY ROW_NUMBER() OVER (PARTITION BY layer_id, loss_view ORDER BY row_version DESC) = 1"
    return f"""SELECT a.loss_analysis_id, a.layer_id, g.day, g.year, g.peril_id, g.event_id, {MONEY_SQL(MONEY_SQL("CAST(g.loss AS DECIMAL(20,8))", "COALESCE(p.load_x_lae, CAST(1 AS DECIMAL(16,10)))"), "COALESCE(CAST(f.fx_rate AS DECIMAL(16,10)), CAST(1 AS DECIMAL(16,10)))")} AS loss, COALESCE(p.lae_load, CAST(1 AS DECIMAL(16,10))) AS lae
    FROM ({newest}) a JOIN (SELECT gu_analysis_id, year, event_id, peril_id, day, CAST(SUM(loss) AS DOUBLE) AS loss FROM gu_yelt_entry GROUP BY ALL) g ON g.gu_analysis_id = a.own_gu_analysis_id
    JOIN layer l ON l.layer_id = a.layer_id LEFT JOIN ({LOADS}) p ON p.loss_analysis_id = a.loss_analysis_id AND p.peril_id = g.peril_id
    LEFT JOIN submission_gu_analysis f ON f.gu_analysis_id = a.own_gu_analysis_id AND f.submission_id = l.submission_id"""


LOADED_WITH_LAE = MONEY_SQL("loss", "lae")


@query("gu_loss_loaded", f"SELECT loss_analysis_id, layer_id, day, year, peril_id, event_id, CAST(ROUND(loss, 6) AS DOUBLE) AS loss, CAST(ROUND({LOADED_WITH_LAE}, 6) AS DOUBLE) AS loss_with_lae FROM ({loaded('TRUE')})")
def gu_loss_loaded(t):
    """Ground-up losses of each layer's newest analysis of each view, loaded and in its currency."""
    newest = y.latest_analyses(t.layer_loss_analysis).withColumn("gu_analysis_id", F.col("own_gu_analysis_id"))
    out = y.loaded_gu_losses(newest, t.gu_yelt_entry, t.layer, t.submission_gu_analysis)
    whole = out.schema["loss"].dataType.typeName() == "long"
    return out.withColumns({n: x.units_to_double(F.col(n), 6) if whole else F.round(n, 6).cast("double") for n in ("loss", "loss_with_lae")})


PACK = "(CAST(day AS BIGINT) << 54) | (CAST(year AS BIGINT) << 39) | (CAST(peril_id AS BIGINT) << 33) | (event_id & 8589934591)"


@query("yelt_key_pack", f"SELECT DISTINCT day, year, peril_id, event_id, {PACK} AS yelt_key FROM layer_yelt")
def yelt_key_pack(t):
    return y.merged_keys(t.layer_yelt).withColumn("yelt_key", x.day_key(F.col("day"), F.col("year"), F.col("peril_id"), F.col("event_id")))


@query("yelt_key_unpack", f"SELECT DISTINCT {PACK} AS yelt_key, day, year, peril_id, event_id FROM layer_yelt")
def yelt_key_unpack(t):
    keys = y.merged_keys(t.layer_yelt).select(x.day_key(F.col("day"), F.col("year"), F.col("peril_id"), F.col("event_id")).alias("yelt_key"))
    return keys.withColumns(x.day_key_parts(F.col("yelt_key")))


@query("acct_period", "SELECT layer_id, CAST(CASE WHEN month(inception) <= 3 THEN (year(inception) - 1) * 100 + 12 ELSE year(inception) * 100 + ((month(inception) - 1) // 3) * 3 END AS INT) AS acct_period FROM layer")
def acct_period(t):
    return t.layer.select("layer_id", x.accounting_period(F.col("inception")).alias("acct_period"))


@query("quarter_end", "SELECT layer_id, CAST(date_trunc('quarter', inception) AS DATE) - 1 AS quarter_end FROM layer")
def quarter_end(t):
    return t.layer.select("layer_id", x.quarter_end(F.col("inception")).alias("quarter_end"))


@query("day_of_year", "SELECT layer_id, CAST(dayofyear(inception) AS INT) AS first_day, CAST(dayofyear(expiration) AS INT) AS last_day FROM layer")
def day_of_year(t):
    return t.layer.select("layer_id", F.dayofyear("inception").alias("first_day"), F.dayofyear("expiration").alias("last_day"))


@query("conditional_date", """SELECT layer_id, eroded, CASE WHEN eroded THEN GREATEST(DATE '1997-06-30', inception) ELSE inception END AS conditional_date FROM layer, (VALUES (TRUE), (FALSE)) e(eroded)
    WHERE CASE WHEN eroded THEN GREATEST(DATE '1997-06-30', inception) ELSE inception END <= expiration""")
def conditional_date(t):
    """The day from which a layer's losses count, with erosion and without, for layers that are then still in force."""
    both = [F.struct(F.lit(e).alias("eroded"), conditional.conditional_date("1997-06-30", F.col("inception"), e).alias("conditional_date")) for e in (True, False)]
    return t.layer.select("layer_id", "expiration", F.inline(F.array(*both))).where("conditional_date <= expiration").select("layer_id", "eroded", "conditional_date")


@query("remaining_limit", """WITH e AS (SELECT layer_id, CAST(SUM(loss_ult) AS DOUBLE) * 100 AS erosion FROM qtd WHERE rc = 1 GROUP BY layer_id)
    SELECT layer_id, GREATEST(agg_limit - erosion, 0) AS remaining_limit, CASE WHEN placement = 0 THEN 0 ELSE premium / placement END AS premium_100pct,
    CASE WHEN erosion > 0 THEN 0 ELSE agg_retention END AS agg_retention FROM layer JOIN e USING (layer_id)""")
def remaining_limit(t):
    eroded = t.qtd.where("rc = 1").groupBy("layer_id").agg((F.sum("loss_ult").cast("double") * 100).alias("erosion"))
    return t.layer.join(eroded, "layer_id").select("layer_id", F.greatest(F.col("agg_limit") - F.col("erosion"), F.lit(0.0)).alias("remaining_limit"), x.ratio(F.col("premium"), F.col("placement")).alias("premium_100pct"), F.when(F.col("erosion") > 0, 0.0).otherwise(F.col("agg_retention")).alias("agg_retention"))


@query("loss_view_remap", "SELECT loss_analysis_id, CAST(CASE loss_view WHEN 10 THEN 1 WHEN 30 THEN 3 WHEN 11 THEN 1 WHEN 33 THEN 3 WHEN 44 THEN 4 ELSE loss_view END AS INT) AS loss_view, CAST(CASE WHEN loss_view IN (10, 30, 11, 33, 44) THEN 0 WHEN loss_view IN (1, 3, 4) THEN 1 ELSE 2 END AS INT) AS priority FROM layer_loss_analysis")
def loss_view_remap(t):
    return t.layer_loss_analysis.select("loss_analysis_id", x.remapped_view(F.col("loss_view")).alias("loss_view"), x.view_priority(F.col("loss_view")).alias("priority"))


@query("scenario_layer_terms", f"""SELECT e.scenario_id, e.event_key, l.layer_id, ROUND({BASIS.format('limit')} / e.fx_rate_to_layer_currency, 6) AS occ_limit, ROUND({BASIS.format('retention')} / e.fx_rate_to_layer_currency, 6) AS occ_retention
    FROM scenario_loss_event e JOIN layer l ON l.layer_id = e.layer_id WHERE e.loss_currency = 'USD'""")
def scenario_layer_terms(t):
    met = t.scenario_loss_event.where("loss_currency = 'USD'").join(t.layer, "layer_id")
    scaled = lambda k: F.round(x.by_basis(F.col("limit_basis"), F.col(f"agg_{k}"), F.col(f"risk_{k}"), F.col(f"occ_{k}")) / F.col("fx_rate_to_layer_currency"), 6).alias(f"occ_{k}")
    return met.select("scenario_id", "event_key", "layer_id", scaled("limit"), scaled("retention"))


@query("yelt_file_names", "SELECT loss_analysis_id, layer_id, row_version, 'Yelt_' || loss_analysis_id || '_' || layer_id || '_' || row_version AS name, CAST(split_part('Yelt_' || loss_analysis_id || '_' || layer_id || '_' || row_version, '_', 4) AS BIGINT) AS version_of_name FROM layer_loss_analysis")
def yelt_file_names(t):
    """The name of each analysis's versioned file, and the version read back from it."""
    named = t.layer_loss_analysis.select("loss_analysis_id", "layer_id", "row_version", F.concat_ws("_", F.lit("Yelt"), "loss_analysis_id", "layer_id", "row_version").alias("name"))
    return named.withColumn("version_of_name", F.split_part("name", F.lit("_"), F.lit(4)).cast("long"))


@query("program_layer_investors", "SELECT retro_program_id, layer_id, string_agg(CAST(retro_investor_id AS VARCHAR), ',' ORDER BY retro_investor_id) AS investors FROM (SELECT DISTINCT i.retro_program_id, a.layer_id, a.retro_investor_id FROM retro_allocation a JOIN retro_investor v USING (retro_investor_id) JOIN sp_insurer i USING (sp_insurer_id)) GROUP BY 1, 2")
def program_layer_investors(t):
    """The investors of each program that a layer is allocated to; a program has few."""
    met = t.retro_allocation.select("layer_id", "retro_investor_id").join(t.retro_investor.select("retro_investor_id", "sp_insurer_id"), "retro_investor_id").join(t.sp_insurer.select("sp_insurer_id", "retro_program_id"), "sp_insurer_id")
    return met.groupBy("retro_program_id", "layer_id").agg(F.array_join(F.array_sort(F.collect_set("retro_investor_id")).cast("array<string>"), ",").alias("investors"))
