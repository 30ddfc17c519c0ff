"""URL filter: site rules, and a character language-model ratio for the URLs that no rule decides.

The URLs that rules accept and reject train two Markov models over characters. A model's order varies: the next character's
probability mixes the estimates after five, four, ... and no characters of context, each weighted by how often and with how
many successors its context was seen (Witten-Bell), so an unseen context falls back to the next shorter one. A URL's score is
the difference of its log-likelihoods a character; the threshold is the one with the best balanced accuracy on a fifth of the
decided URLs that the models have not seen.

All of it is DataFrame operations over the URLs' own characters, so the table of contexts grows with the URLs. It is built
from the longest contexts down by aggregates and mixed from the shortest up by joins. Grams that stand in very many URLs are
joined by a broadcast of bounded size, so no join has a hot key. Log-likelihoods are whole millionths, so sums don't depend
on the order of rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inuring.llm.scratch import intermediate, written
from inuring.llm.text import fresh

#: (verdict, host, path): a rule fits its host and all subdomains if the URL's path starts with the rule's.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
#: Characters of context at most, and the signs before and after a URL.
CONTEXT, BEFORE, AFTER = 5, "\x02", "\x03"
#: A key with more than one in so many of the rows is joined by a broadcast; there are at most so many.
HOT = 1000
#: One of so many decided URLs is held out to set the threshold.
HELD_OUT = 5
#: Width of the score bins that the threshold is chosen from, in nats a character.
BIN = 0.01
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def lower(text: Column) -> Column:
    """A-Z lower-cased, all else as it is."""
    return F.translate(text, _UPPER, _UPPER.lower())


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The host after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased, and the path from there up to
    ``?``, ``#`` or the end; both empty for a null URL or one without ``://``."""
    at = F.instr(url, "://")
    rest = F.substring(url, at + 3, F.length(url))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(url)), "^[^?#]*", 0)
    there = at > 0
    return F.when(there, lower(host)).otherwise(""), F.when(there, path).otherwise("")


def matching_rule(host: Column, path: Column, rules: tuple[tuple[str, str, str], ...]) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, null if none does."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1] + r[2])):
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        found = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def held_out(url: Column) -> Column:
    """True for one URL in HELD_OUT, by a hash that other engines have too."""
    return F.conv(F.substring(F.md5(url), 1, 8), 16, 10).cast("long") % HELD_OUT == 0


def grams(urls: DataFrame, url: str, keep: list[str]) -> DataFrame:
    """``keep`` and ``gram``, a row for each character of the URL, lower-cased, and its end: CONTEXT characters before, and it."""
    signs = F.split(F.concat(F.lit(BEFORE * CONTEXT), lower(F.col(url)), F.lit(AFTER)), "")
    spelled = urls.select(*keep, signs.alias("signs"))
    starts = F.sequence(F.lit(1), F.size("signs") - CONTEXT)
    return spelled.select(*keep, F.explode(F.transform(starts, lambda i: F.array_join(F.slice("signs", i, CONTEXT + 1), ""))).alias("gram"))


def log_ratios(counts: DataFrame) -> DataFrame:
    """(gram, n, ratio): the accepted model's log-probability of the last character less the rejected one's, in millionths.

    ``counts`` has each gram of the URLs once, with ``n`` (all URLs), ``accepted`` and ``rejected`` (those to train on).
    """
    orders = [counts.select("gram", "n", "accepted", "rejected")]
    for k in range(CONTEXT, 0, -1):  # without the character furthest away
        shorter = orders[-1].groupBy(F.substring("gram", 2, k).alias("gram")).agg(*[F.sum(c).alias(c) for c in ("n", "accepted", "rejected")])
        orders.append(written(shorter))
    least = orders.pop()
    whole = least.agg(F.count("*").alias("signs"), F.sum("accepted").alias("accepted"), F.sum("rejected").alias("rejected")).first()
    own = lambda n: (F.col(n) + 1) / F.lit(float((whole[n] or 0) + whole["signs"] + 1))
    mixed = least.select("gram", own("accepted").alias("accepted_p"), own("rejected").alias("rejected_p"))
    for k, table in enumerate(reversed(orders), 1):
        # a context has as many rows as there are characters
        context = Window.partitionBy(F.substring("gram", 1, k))
        for n in ("accepted", "rejected"):
            table = table.withColumns({f"{n}_all": F.sum(n).over(context), f"{n}_kinds": F.sum((F.col(n) > 0).cast("long")).over(context)})
        lower_order = mixed.select(F.col("gram").alias("shorter"), F.col("accepted_p").alias("accepted_s"), F.col("rejected_p").alias("rejected_s"))
        table = table.join(lower_order, F.substring("gram", 2, k) == F.col("shorter"))
        blend = lambda n: F.when(F.col(f"{n}_all") > 0, (F.col(n) + F.col(f"{n}_kinds") * F.col(f"{n}_s")) / (F.col(f"{n}_all") + F.col(f"{n}_kinds"))).otherwise(F.col(f"{n}_s"))
        mixed = written(table.select("gram", "n", blend("accepted").alias("accepted_p"), blend("rejected").alias("rejected_p")))
    return mixed.select("gram", "n", F.round((F.log("accepted_p") - F.log("rejected_p")) * 1e6).cast("long").alias("ratio"))


def _joined(rows: DataFrame, keys: DataFrame, key: str, weight: str, total: int) -> DataFrame:
    """``rows`` with the columns of ``keys``, which has every ``key`` of theirs once and its ``weight`` (rows): the HOT keys at
    most that more than one in HOT rows have are broadcast, so no task gets all rows of one."""
    hot = F.col(weight) * HOT > total
    common = keys.where(hot).drop(weight)
    rest = rows.join(F.broadcast(common.select(key)), key, "left_anti").join(keys.where(~hot).drop(weight), key)
    return rows.join(F.broadcast(common), key).unionByName(rest)


def threshold(scores: DataFrame) -> float:
    """The score (millionths) from which URLs are accepted: among the bins of the held-out rows' scores the lowest with the
    best balanced accuracy, half-way to the bin below it; 0 if a verdict is missing. ``scores`` has score, verdict, weight."""
    width = int(BIN * 1e6)
    bins = scores.groupBy(F.floor(F.col("score") / width).alias("bin")).agg(
        F.sum(F.when(F.col("verdict") == "allow", F.col("weight")).otherwise(0)).alias("good"), F.sum(F.when(F.col("verdict") == "block", F.col("weight")).otherwise(0)).alias("bad")
    )
    whole, below = Window.partitionBy(), Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)  # of bins, not of rows
    share = bins.select("bin", F.coalesce(F.lag("bin").over(Window.orderBy("bin")) + 1, F.col("bin")).alias("free"), F.sum("good").over(whole).alias("goods"), F.sum("bad").over(whole).alias("bads"), F.coalesce(F.sum("good").over(below), F.lit(0)).alias("lost"), F.coalesce(F.sum("bad").over(below), F.lit(0)).alias("caught"))
    best = share.where("goods > 0 and bads > 0").orderBy(F.desc((F.col("goods") - F.col("lost")) * F.col("bads") + F.col("caught") * F.col("goods")), "bin").first()
    return 0.0 if best is None else (best["free"] + best["bin"]) * width / 2


def judge_urls(df: DataFrame, url: str = "url", rules: tuple[tuple[str, str, str], ...] = RULES) -> DataFrame:
    """``df`` with ``host``, ``path``, ``rule`` (null if none fits), ``score`` (nats a character over the threshold) and
    ``verdict`` (allow or block): the longest fitting rule's, else allow from a score of 0.

    A null URL and one without ``://`` have empty host and path; the models score a null URL as an empty one. Rows of equal
    URLs are scored once and get equal verdicts; each counts in training. If rules decide no URL, all scores are 0 and the
    rest is allowed. An empty table stays empty. Names that ``df`` has already get underscores.
    """
    address = F.coalesce(F.col(url), F.lit(""))
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    names = fresh(df, "host", "path", "rule", "score", "verdict")
    key, value, rule, many = fresh(df, "url_key", "url_score", "url_rule", "url_rows")
    with intermediate(df.sparkSession) as results:
        urls = df.select(address.alias("u")).groupBy("u").agg(F.count("*").alias("weight"))
        urls = urls.withColumn("verdict", matching_rule(*host_and_path(F.col("u")), rules)["verdict"]).withColumn("held", held_out(F.col("u")))
        urls = written(urls.withColumn("number", F.monotonically_increasing_id()))
        # URLs are small but for their grams, so they are dealt to all tasks again
        spread = grams(urls.repartition(parts, "number"), "u", ["number", "weight", "verdict", "held"])
        times = lambda v: F.sum(F.when((F.col("verdict") == v) & ~F.col("held"), F.col("weight")).otherwise(0))
        counts = written(spread.groupBy("gram").agg(F.count("*").alias("n"), times("allow").alias("accepted"), times("block").alias("rejected")))
        ratios = written(log_ratios(counts))
        total = ratios.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
        scores = _joined(spread.select("number", "gram"), ratios, "gram", "n", total).groupBy("number").agg((F.sum("ratio") / F.count("*")).alias("score"))
        scores = written(urls.join(scores, "number").select("u", "weight", "verdict", "held", "score"))
        least = threshold(scores.where("held and verdict is not null"))
        results.append(scores.select(F.col("u").alias(key), F.col("weight").alias(many), ((F.col("score") - least) / 1e6).alias(value)))
    scored = results[0]
    host, path = host_and_path(F.col(url))
    out = df.withColumns({names[0]: host, names[1]: path}).withColumn(rule, matching_rule(F.col(names[0]), F.col(names[1]), rules))
    out = _joined(out.withColumn(key, address), scored, key, many, df.count())
    chosen = F.coalesce(F.col(rule)["verdict"], F.when(F.col(value) >= 0, "allow").otherwise("block"))
    out = out.withColumns({names[2]: F.col(rule)["rule"], names[3]: F.col(value), names[4]: chosen})
    return out.select(*df.columns, *names)
