"""Premium and limit metrics of layers under retro programs, and peak exposure by day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inuring.functions.terms import MONEY, SHARE, by_basis, days, ratio, share, sign, times
from inuring.operators.audit import DEFAULT, DROP, FAIL, Audit
from inuring.operators.intervals import changes

PREMIUMS, LIMITS = ("ceded_premium", "subject_premium", "subject_placed_premium"), ("deposit_limit", "subject_limit", "subject_placed_limit", "ceded_limit")


def peaks(df: DataFrame, key: list[str], s: str, e: str, values: list[str], sums: list[str] = ()) -> DataFrame:
    """(key, peak_..., sums): the largest daily sums of ``values`` over the closed periods of a key, on days with a period, and
    plain sums of other columns, in one pass. Changes at the periods' bounds instead of a row for each day. They are dealt by key and date
    before they are summed: before that few of them share a date, so a map-side sum would hold almost all of them in memory."""
    moves = changes(df, s, e, {v: F.col(v) for v in values}, key, sums).repartition(*key, "at")
    by_date = moves.groupBy(*key, "at").agg(F.sum("open").alias("open"), *[F.sum(c).alias(c) for c in (*values, *sums)])
    w = Window.partitionBy(*key).orderBy("at")
    running = by_date.select(*key, *sums, F.sum("open").over(w).alias("open"), *[F.sum(v).over(w).alias(v) for v in values])
    return running.groupBy(*key).agg(*[F.max(F.when(F.col("open") > 0, F.col(v))).alias(f"peak_{v}") for v in values], *[F.sum(c).alias(c) for c in sums])


def peak_limits(df: DataFrame, key: list[str], s: str, e: str, value: str) -> DataFrame:
    """(key, peak) of one value."""
    return peaks(df, key, s, e, [value]).withColumnRenamed(f"peak_{value}", "peak")


def layer_metrics(net: DataFrame, layers: DataFrame, submissions: DataFrame, rates: DataFrame, placements: DataFrame, missing: str = FAIL, audit: Audit | None = None) -> DataFrame:
    """Premiums and limits of each piece of net cession (layer_id, level, retro_program_id, start, end, gross, net), as
    decimals: quotients are rounded once, products after each factor, sums are exact.

    A piece whose layer has no rate fails the run; with ``missing`` it is left out or counts at a rate of 1, and is counted in the
    ``audit``. Pieces of layers or submissions that aren't there are left out, pairs without a placement count whole; the audit
    has both. ``placements`` go by layer and program, or by program and the layer's top_up_zone_id: these are few, so they are looked up where
    the pieces are.
    """
    audit = audit or Audit()
    by = [k for k in ("layer_id", "retro_program_id", "top_up_zone_id") if k in placements.columns]
    zone = [k for k in by if k not in net.columns]
    terms = layers.select(
        "layer_id", "submission_id", "placement", "premium", "limit_basis", "agg_limit", "risk_limit", "occ_limit", "signed_share", "estimated_share", "inception", "expiration", "status", *zone
    )
    own = terms.join(submissions.select("submission_id", "tran_type"), "submission_id").join(rates, "layer_id")
    # a layer's deposits are the same for all its pieces, so they are made before these meet it
    sized: list[Column] = [share(F.col("signed_share"), F.col("estimated_share")), F.coalesce("fx", F.lit(1.0)), sign(F.col("tran_type"))]
    limit = by_basis(F.col("limit_basis"), F.col("agg_limit"), F.col("risk_limit"), F.col("occ_limit"))
    own = own.withColumns({"deposit_premium": times(ratio(F.col("premium"), F.col("placement")).cast(MONEY), *sized), "deposit_limit": times(limit.cast(MONEY), *sized)})
    own = own.select("layer_id", "inception", "expiration", "status", *zone, "fx", "asked", "deposit_premium", "deposit_limit")
    out = audit.join(net, own, ["layer_id"], "layers of net cessions", DROP)
    out = audit.settle(out, F.col("fx").isNotNull(), "rates", F.col("asked"), missing).drop("fx", "asked")
    out = out.join(placements.select(*by, F.col("placement").alias("retro_placement")), by, "left")
    pair = F.concat_ws(" ", *[F.coalesce(F.col(k).cast("string"), F.lit("null")) for k in ("layer_id", "retro_program_id")])
    out = audit.settle(out, F.col("retro_placement").isNotNull(), "placements", pair, DEFAULT).withColumn("retro_placement", F.coalesce("retro_placement", F.lit(1.0))).drop(*zone)
    part = (days(F.col("start"), F.col("end")) / days(F.col("inception"), F.col("expiration"))).cast(SHARE)
    kept = ratio(F.col("net").cast("double"), F.col("gross").cast("double")).cast(SHARE)
    out = out.withColumns({"available": times(F.col("deposit_premium"), part), "net_to_gross": kept})
    out = out.withColumns({"subject_premium": times(F.col("available"), F.col("net_to_gross")), "subject_limit": times(F.col("deposit_limit"), F.col("net_to_gross"))})
    return out.withColumns({
        "ceded_premium": times(F.col("available"), F.col("net")),
        "subject_placed_premium": times(F.col("subject_premium"), F.col("retro_placement")),
        "subject_placed_limit": times(F.col("subject_limit"), F.col("retro_placement")),
        "ceded_limit": times(F.col("deposit_limit"), F.col("net")),
    })


def program_metrics(by_layer: DataFrame) -> DataFrame:
    """Premium sums and peak limits of each program."""
    return peaks(by_layer, ["retro_program_id"], "start", "end", ["ceded_limit", "subject_limit"], list(PREMIUMS))
