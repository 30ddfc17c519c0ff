"""Divergence of sources by wide term vectors.

Occurrences are counted by language, source and term, chunk by chunk in numpy, and summed up map-side. Each kept term is then pivoted into an array with a place for
every source of its language; higher-order functions turn the arrays into shares and emit the contribution of each pair of
sources, a place after the other, and the contributions are summed map-side again. So what is shuffled grows with the distinct
terms and with the pairs of sources, which are the result, and not with documents or with occurrences.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inuring.llm.scratch import intermediate, written
from inuring.llm.text import CHUNK_BYTES, bound_batches, byte_table, chunks

#: ``[^\x00-\x40\x5B-\x60\x7B-\x7F]``: letters and characters beyond ASCII
TERM = ~byte_table([(0x00, 0x40), (0x5B, 0x60), (0x7B, 0x7F)])
#: Documents of a language that a kept term has to be in.
LEAST_DOCS = 10
#: Terms that a source is reported with.
TOP_TERMS = 10
#: Shares are billionths.
SCALE = 1_000_000_000
#: Copies of a language's sources, so that the terms of a language with most of the rows meet them in many tasks.
SPREAD = 64


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def smoothed(n: Column, total: Column, kept: Column) -> Column:
    """1 + floor(SCALE * (n + 2) / (total + 2 * kept)) in longs: three digits of the quotient at a time, as n + 2 is at most the
    divisor wherever there is a kept term. Exact up to 9e15 occurrences."""
    d = total + 2 * kept
    first = (n + 2) * 1000
    second = (first % d) * 1000
    third = (second % d) * 1000
    return _div(first, d) * 1_000_000 + _div(second, d) * 1000 + _div(third, d) + 1


def divergence_of(p: Column, q: Column) -> Column:
    return _div((p - q) * (p - q), p + q)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, text) to (lang, source, term, n, docs): each term of a chunk's languages and sources once."""
    for batch in batches:
        for part, texts in chunks(batch, "text", 2 * CHUNK_BYTES):
            words = texts.words(TERM, lower=True)
            code, terms = words.encoded()
            names = [part.column(c).dictionary_encode() for c in ("lang", "source")]
            lang, source = (x.indices.to_numpy(zero_copy_only=False).astype(np.int64) for x in names)
            group = lang * (len(names[1].dictionary) + 1) + source
            in_doc, n = np.unique(words.doc * (len(terms) + 1) + code, return_counts=True)
            doc, code = np.divmod(in_doc, len(terms) + 1)
            in_group, own = np.unique(group[doc] * (len(terms) + 1) + code, return_inverse=True)
            group, code = np.divmod(in_group, len(terms) + 1)
            lang, source = np.divmod(group, len(names[1].dictionary) + 1)
            columns = [names[0].dictionary.take(pa.array(lang)), names[1].dictionary.take(pa.array(source)), terms.take(pa.array(code)).cast(pa.string())]
            counts = [pa.array(np.bincount(own, weights=w, minlength=len(in_group)).astype(np.int64)) for w in (n, np.ones(len(n)))]
            yield pa.RecordBatch.from_arrays([*columns, *counts], names=["lang", "source", "term", "n", "docs"])


def term_counts(df: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs) of (lang, source, text): occurrences, and rows with the term. A-Z are lower-cased."""
    bound_batches(df.sparkSession)
    each = df.mapInArrow(_count, "lang string, source string, term string, n long, docs long")
    return each.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _with_sources(terms: DataFrame, sources: DataFrame) -> DataFrame:
    """Rows of terms with their language's row; a language's terms meet it in SPREAD places."""
    salted = sources.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))))
    return terms.withColumn("salt", F.pmod(F.xxhash64("term"), F.lit(SPREAD)).cast("int")).join(salted, ["lang", "salt"]).drop("salt")


def _ranked(rows: DataFrame, part: str, most: int | None = None) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = rows.withColumn("rank", F.row_number().over(order))
    if most is not None:
        ranked = ranked.where(F.col("rank") <= most)
    return ranked.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")


def source_divergence(df: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", least_docs: int = LEAST_DOCS, top: int = TOP_TERMS) -> DataFrame:
    """(lang, source, part, item, value, rank) of every language and source of ``df``.

    Part ``pair`` has each other source of the language and the divergence from it, summed over the language's kept terms;
    part ``term`` the ``top`` kept terms that stand in the source and have a greater share there than in the language, with
    the divergence of the two shares. Ranks go by value, descending, then item by UTF-8 bytes.

    A null text, language or source counts as an empty string. Repeated rows count each. A language without kept terms gives
    pairs of value 0; one with a single source gives no pairs; an empty table gives no rows. Further columns of ``df``, of
    whatever name, are left out. Values are exact.
    """
    string = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = df.select(string(lang).alias("lang"), string(source).alias("source"), string(text).alias("text"))
    with intermediate(df.sparkSession) as results:
        by_term = term_counts(rows).groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.collect_list(F.struct("source", "n")).alias("by"))
        kept = written(by_term.where(F.col("docs") >= least_docs).select("lang", "term", "by"))
        totals = kept.select("lang", F.inline("by")).groupBy("lang", "source").agg(F.sum("n").alias("total"))
        size = kept.groupBy("lang").agg(F.count("*").alias("kept"))
        groups = rows.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").fillna(0, ["total"])
        sources = groups.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("source", "total"))).alias("sources"))
        sources = written(sources.join(size, "lang", "left").fillna(0, ["kept"]))

        # a place for each source: its occurrences of the term, and their share
        zero = F.lit(0).cast("long")
        own = lambda s: F.coalesce(F.get(F.filter("by", lambda e: e["source"] == s["source"]), F.lit(0))["n"], zero)
        wide = _with_sources(kept, sources).select("lang", "term", "kept", "sources", F.transform("sources", own).alias("n"))
        share = lambda n, s: smoothed(n, s["total"], F.col("kept"))
        total = F.aggregate("sources", zero, lambda x, s: x + s["total"])
        everywhere = F.aggregate("n", zero, lambda x, n: x + n)
        wide = written(
            wide.select("lang", "term", F.transform("sources", lambda s: s["source"]).alias("names"), "n", F.zip_with("n", "sources", share).alias("p"), smoothed(everywhere, total, F.col("kept")).alias("q"))
        )

        # each term gives a row for each source but the last, and that one a contribution for each source after it
        first = wide.select("lang", "p", F.posexplode("p").alias("a", "share")).where(F.col("a") < F.size("p") - 1)
        after = F.transform(F.slice("p", F.col("a") + 2, F.size("p")), lambda q: divergence_of(F.col("share"), q))
        emitted = first.select("lang", "a", F.posexplode(after).alias("d", "value"))
        sums = emitted.groupBy("lang", "a", (F.col("a") + F.col("d") + 1).alias("b")).agg(F.sum("value").alias("value"))
        named = sources.select("lang", F.posexplode(F.col("sources")["source"]).alias("a", "source"), F.col("sources")["source"].alias("names"))
        pairs = named.select("lang", "a", "source", F.posexplode("names").alias("b", "item")).where("a <> b")
        both = sums.unionByName(sums.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value"))
        pairs = pairs.join(both, ["lang", "a", "b"], "left").select("lang", "source", "item", F.coalesce("value", zero).alias("value"))

        cells = wide.select("lang", F.col("term").alias("item"), "q", F.inline(F.arrays_zip(F.col("names").alias("source"), F.col("n"), F.col("p"))))
        marked = cells.where("n > 0 and p > q").select("lang", "source", "item", divergence_of(F.col("p"), F.col("q")).alias("value"))
        results.append(_ranked(pairs, "pair").unionByName(_ranked(marked, "term", top)))
    return results[0]
