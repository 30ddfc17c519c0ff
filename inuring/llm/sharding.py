"""Sharding by proportional stratified interleaving.

Within each source the rows are shuffled by a seeded hash and ranked; all rows are then sorted by their fractional rank in
their source and the sequence is cut into shards of equal counts, so each shard has the sources in the table's proportions.
A source begins at a phase of its own, (rank + phase) / rows: sources of one size share the phases out evenly, so thousands of
sources of one row are spread over all shards and don't tie.

Ranks over a whole source, and over the whole table, are made from ranks inside slices of bounded size and running counts of
the slices before, so no source is ever gathered in one task. Texts are not shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inuring.llm.scratch import written
from inuring.llm.text import fresh

SEED = 17
#: Rows that a slice has on average, and slices that are counted up together.
SLICE_ROWS, SLICES = 1_000, 1_000


def _even(hash: Column) -> Column:
    """A number in [0, 1) from the first 32 bits of a hash in hexadecimal digits."""
    return F.conv(F.substring(hash, 1, 8), 16, 10).cast("double") / float(1 << 32)


def _ranked(rows: DataFrame, group: list[str], slices: Column, order: list[Column], to: str) -> DataFrame:
    """``rows`` with the rank (from 0) within the group by slice and then ``order``; slices follow that order."""
    sliced = rows.withColumn("slice", slices.cast("long"))
    keys = [*group, "slice"]
    counts = sliced.groupBy(*keys).agg(F.count("*").alias("own")).withColumn("part", F.expr(f"slice div {SLICES}"))
    running = lambda by, at: F.sum("own").over(Window.partitionBy(*by).orderBy(at)) - F.col("own")
    parts = counts.groupBy(*group, "part").agg(F.sum("own").alias("own"))
    parts = parts.select(*[F.col(k).alias(f"{k}_p") for k in (*group, "part")], running(group, "part").alias("before_part"))
    same_part = [F.col(k).eqNullSafe(F.col(f"{k}_p")) for k in (*group, "part")]
    before = counts.withColumn("before", running([*group, "part"], "slice")).join(parts, same_part)
    before = before.select(*[F.col(k).alias(f"{k}_b") for k in keys], (F.col("before") + F.col("before_part")).alias("before"))
    inside = F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1
    same = [F.col(k).eqNullSafe(F.col(f"{k}_b")) for k in keys]
    out = sliced.withColumn("inside", inside).join(before, same)
    return out.withColumn(to, (F.col("inside") + F.col("before")).cast("long")).drop("inside", "before", "slice", *[f"{k}_b" for k in keys])


def _phases(rows: DataFrame, seed: int, slice_rows: int) -> DataFrame:
    """(source_t, total, phase) of each source: its rows, and where between two of its places it begins. The k-th of so many
    sources of one size, in the order of a seeded hash, takes the k-th of so many equal steps, shifted by a hash of the size."""
    sizes = rows.groupBy("source").agg(F.count("*").alias("total"))
    sizes = sizes.withColumn("own_hash", F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("source").cast("string"), F.lit("")))))
    sizes = written(sizes.join(sizes.groupBy("total").agg(F.count("*").alias("alike")), "total"))
    slices = F.floor(_even(F.col("own_hash")) * F.ceil(F.col("alike") / slice_rows))
    ranked = _ranked(sizes, ["total"], slices, [F.col("own_hash"), F.col("source")], "k")
    shift = _even(F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("total").cast("string"))))
    return written(ranked.select(F.col("source").alias("source_t"), "total", ((F.col("k") + shift) / F.col("alike")).alias("phase")))


def assign_shards(df: DataFrame, shards: int, id: str = "doc_id", source: str = "source", text: str = "text", seed: int = SEED, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """(id, source, size, text_crc32, shard, slot) of each row: UTF-8 bytes plus 8, the crc32 of the text, its shard from 0 and
    its place there from 0. Counts of shards differ by one at most (law ``rows``).

    A null text has size 8 and the crc32 of the empty string; empty texts likewise. Null sources are one source. Ties in the
    shuffle go by id, size and crc32; rows equal in all of these take neighbouring places in either order. A source has in each
    shard its rows over the shards, give or take one at each cut and what chance leaves of the other sources there. Shards beyond the
    number of rows stay empty; an empty table gives an empty table.
    """
    if shards < 1:
        raise ValueError("shards must be positive")
    body = F.coalesce(F.col(text), F.lit("")).cast("binary")
    rows = df.select(F.col(id).alias("id"), F.col(source).alias("source"), (F.octet_length(body) + 8).cast("long").alias("size"), F.crc32(body).cast("long").alias("crc"))
    rows = rows.withColumn("shuffle", F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("id").cast("string"), F.lit("")))))
    n = df.count()
    order = [F.col("shuffle"), F.col("id"), F.col("size"), F.col("crc")]
    sized = rows.join(_phases(rows, seed, slice_rows), F.col("source").eqNullSafe(F.col("source_t"))).drop("source_t")
    # hashes are even, so ranges of their first 32 bits are slices of even size; fractions are even by their making
    ranked = _ranked(sized, ["source"], F.floor(_even(F.col("shuffle")) * F.ceil(F.col("total") / slice_rows)), order, "rank")
    placed = ranked.withColumn("fraction", (F.col("rank") + F.col("phase")) / F.col("total")).drop("total", "phase")
    slices = max(1, -(-n // slice_rows))
    placed = written(_ranked(placed, [], F.floor(F.col("fraction") * slices), [F.col("fraction"), F.col("source"), *order], "place"))
    shard = F.expr(f"place * {shards} div {max(n, 1)}")
    start = F.expr(f"(place * {shards} div {max(n, 1)} * {n} + {shards - 1}) div {shards}")  # of the shard's first place
    names = fresh(df.select(id), "source", "size", "text_crc32", "shard", "slot")
    return placed.withColumn("shard", shard.cast("int")).select(F.col("id").alias(id), F.col("source").alias(names[0]), F.col("size").alias(names[1]), F.col("crc").alias(names[2]), F.col("shard").alias(names[3]), (F.col("place") - start).cast("long").alias(names[4]))
