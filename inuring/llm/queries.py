"""The opN_ queries: each operator over its whole table with production parameters, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from inuring.llm.decontam import find_matches, items_hit, words_hit
from inuring.llm.divergence import source_divergence
from inuring.llm.encoding import token_output
from inuring.llm.licenses import scan_licenses
from inuring.llm.mixing import label_domains, mix
from inuring.llm.neardup import near_duplicates
from inuring.llm.oracles import ORACLE_SQL  # noqa: F401
from inuring.llm.periodic import collapse_runs
from inuring.llm.quality import quality_report
from inuring.llm.repeats import find_repeats, kept_bytes
from inuring.llm.secrets import BASE_RULES, scan_secrets
from inuring.llm.sharding import assign_shards
from inuring.llm.urls import judge_urls
from inuring.llm.wordpiece import byte_pieces, count_tokens


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards of equal counts (law ``rows``)."""
    placed = assign_shards(table(spark, sf_dir, "documents", "doc_id", "source", "text"), 24)
    return placed.select("doc_id", "source", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each document inside a benchmark window, and the items whose windows it has."""
    found = find_matches(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark", "item_id", "text"), keep_text=False)
    found = found.select("doc_id", "n_words", words_hit(F.col("matches")).alias("n_hit"), items_hit(F.col("matches")).alias("items"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words and greedy pieces of each document by the 50k byte vocabulary."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return count_tokens(docs, *byte_pieces(public_tokenizers.path("byte_bpe_50k.json")), keep_text=False)


def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict of each page's URL, by rule or model."""
    return judge_urls(table(spark, sf_dir, "pages", "page_id", "url")).select("page_id", "host", "path", "rule", "score", "verdict")


def _joined(spans: Column) -> Column:
    """kind:start:end of the spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _of_kinds(kinds: list[str]) -> Column:
    return F.filter("found", lambda s: s["kind"].isin(kinds))


def op5_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of each document: counts of the base rules, their digest, and the spans of all rules."""
    found = scan_secrets(table(spark, sf_dir, "documents", "doc_id", "text"), name="found", keep_text=False)
    base = [r.kind for r in BASE_RULES]
    counts = [F.size(_of_kinds([k])).cast("long").alias(f"n_{k}") for k in base]
    digest = F.sha2(_joined(_of_kinds(base)), 256)
    return found.select("doc_id", *counts, digest.alias("base_sha256"), _joined(F.col("found")).alias("spans"))


def op6_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases and labels of each document."""
    found = scan_licenses(table(spark, sf_dir, "documents", "doc_id", "text"), keep_text=False)
    starts = F.transform("phrases", lambda p: p["start"])
    base = F.array_sort(F.array_distinct(F.transform("phrases", lambda p: p["label"])))
    return found.select(
        "doc_id",
        "n_words",
        F.size("phrases").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        F.array_join(base, ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"),
        "score",
    )


def op7_token_id_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the token files hold of each document: start, number and checksum of its ids."""
    import public_tokenizers

    found = token_output(table(spark, sf_dir, "documents", "doc_id", "text"), public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    return found.select(F.col("id").alias("doc_id"), "start", "n_tokens", "ids_crc32")


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures of each document and the verdict of all rules."""
    report = quality_report(table(spark, sf_dir, "documents", "doc_id", "text"), keep_text=False)
    base_failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return report.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base_failed.alias("base_failed"), "kept")


def op9_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate group of each document, and whether it is the one to keep."""
    found = near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"))
    return found.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


#: Shares of the tokens that the domains are to have.
TARGETS = {"good": 0.92, "poor": 0.07, "toxic": 0.01}


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Domain probabilities, rate and copies of each document for the target shares."""
    docs = table(spark, sf_dir, "documents", "doc_id", "source", "text")
    mixed = mix(docs, label_domains(table(spark, sf_dir, "labels", "doc_id", "quality", "toxic")), TARGETS, keep_text=False)
    return mixed.select("doc_id", "source", "n_tokens", *[F.col("memberships")[d].alias(f"p_{d}") for d in TARGETS], "rate", "copies")


def op11_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of each document inside 400-byte strings that stand more than once, and the digest of the others."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text").withColumn("n_bytes", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long"))
    found = find_repeats(docs, derive=lambda text, removed: {"kept_sha256": F.sha2(kept_bytes(text, removed), 256)}, keep_text=False)
    n_removed = F.aggregate("removed", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select("doc_id", "n_bytes", n_removed.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"), "kept_sha256")


def planted(doc_id: Column, text: Column) -> Column:
    """The text, or for a tenth of the ids (by crc32) its words with the tail made periodic, joined by one space."""
    words = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    h = F.crc32(doc_id.cast("string"))
    g, n = F.floor(h / 10).cast("long"), F.size(words).cast("long")

    def tail(w: Column) -> Column:
        a = (g % F.size(w)).cast("int")
        p = (1 + F.floor((F.size(w) - a) / (3 + g % 8))).cast("int")
        return F.array_join(F.transform(F.sequence(F.lit(0), F.size(w) - 1), lambda i: F.get(w, F.when(i < a, i).otherwise(a + (i - a) % p))), " ")

    # the words are found once: a lambda over an array that holds them
    return F.when((h % 10 == 0) & (n > 0), F.transform(F.array(words), tail)[0]).otherwise(text)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of each document, the one with the greatest exponent, and digests of all and of the collapsed text."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    found = collapse_runs(docs.select("doc_id", planted(F.col("doc_id"), F.col("text")).alias("text")), keep_text=False)
    more = lambda a, b: F.when(a.isNull() | (b["length"] * a["period"] > a["length"] * b["period"]), b).otherwise(a)
    best = F.aggregate("runs", F.lit(None).cast("struct<start:long,length:long,period:long>"), more)
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")]), F.lit("\n"))), "")
    found = found.withColumns({"best": best, "lines": lines})
    exponent = F.call_function("div", 1000 * F.col("best.length"), F.col("best.period"))
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period", exponent.alias("exponent_milli"), F.sha2("lines", 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far the sources of each language diverge, and the terms that mark each source."""
    return source_divergence(table(spark, sf_dir, "documents", "text", "lang", "source"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sharding": op1_sharding,
    "op2_decontamination": op2_decontamination,
    "op3_token_counts": op3_token_counts,
    "op4_url_filters": op4_url_filters,
    "op5_secret_scans": op5_secret_scans,
    "op6_license_scans": op6_license_scans,
    "op7_token_id_output": op7_token_id_output,
    "op8_quality_rules": op8_quality_rules,
    "op9_minhash_near_dedup": op9_minhash_near_dedup,
    "op10_mixing": op10_mixing,
    "op11_suffix_array_dedup": op11_suffix_array_dedup,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_source_divergence": op13_source_divergence,
}
