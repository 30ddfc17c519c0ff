"""Mixing to target weights with soft memberships.

A classifier trained on a labelled table predicts for each document the probability of every domain: Bernoulli naive Bayes
on the presence of the words that tell domains apart. Nonnegative document rates are then fitted by projected gradient
least squares, so that the expected tokens of each domain (rate x tokens x probability) match its target.

All of it is DataFrame operations. Probabilities are whole thousandths that add up to one, and a rate depends on a document
only through them; so documents of equal probabilities are summed up first, and a step of the fit is an aggregate over as
many rows as there are grid points at most. Only the domains' sums go to the driver, a step at a time. Documents are
classified once, to a table in the shared folder from which both the sums and the rows are read.
"""

from __future__ import annotations

import math
import warnings
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inuring.llm.scratch import written
from inuring.llm.text import fresh

#: Labelled documents that the classifier is trained on at most, those of the smallest hashes.
MOST_LABELLED = 10_000
#: Words that the classifier looks for: all those in so many documents of a domain that make it likelier by this log-odds
#: ratio at least, by its z-score.
LEAST_SEEN, LEAST_ODDS, LEAST_Z = 5, 2.0, 3.0
#: The distance from every target, as a share of it, at which it is met.
CLOSE = 1e-3
#: Lengths of a step of the fit, each begun where the shorter one ended, and the share by which a further gradient step would still
#: change the rates (root mean square over tokens) at which no rates are nearer.
LONG, STILL = (1e3, 1e5, 1e7), 1e-6
#: Shares of a Newton step that are tried at once, and the slope (as a share of a domain's tokens) at which its place is found.
SIZES, EVEN = tuple(4.0**-i for i in range(10)), 1e-8
UNIT = 1000


def words_of(text: Column) -> Column:
    """The runs without white space, lower-cased; a null text has none."""
    plain = F.lower(F.coalesce(text, F.lit("")))
    for sign in "\t\n\x0b\x0c\r":
        plain = F.replace(plain, F.lit(sign), F.lit(" "))
    return F.array_remove(F.split(plain, " "), "")


def label_domains(labels: DataFrame) -> DataFrame:
    """(doc_id, domain) of the labelled table: toxic, else good or poor by quality; rows without both labels are left out."""
    known = labels.where("doc_id is not null and quality is not null and toxic is not null")
    return known.select("doc_id", F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "good").otherwise("poor").alias("domain"))


class Classifier:
    """Log-odds of each domain: ``base`` plus, for each word that stands in the text, ``weights[word]``."""

    def __init__(self, domains: list[str], base: list[float], weights: dict[str, list[float]], hashes: dict[str, int]):
        self.domains, self.base, self.weights, self.hashes = domains, base, weights, hashes  # each word's xxhash64

    @staticmethod
    def fit(df: DataFrame, labelled: DataFrame, domains: list[str], id: str, text: str) -> Classifier:
        """From at most MOST_LABELLED documents; labels of other domains are left out, and so are documents that have labels of
        several domains. Without any, all domains are as likely."""
        chosen = labelled.select(F.col("doc_id").alias("label_id"), "domain").where(F.col("domain").isin(domains))
        chosen = chosen.groupBy("label_id").agg(F.min("domain").alias("domain"), F.max("domain").alias("other")).where("domain = other").drop("other")
        chosen = written(chosen.orderBy(F.xxhash64("label_id"), "label_id").limit(MOST_LABELLED))
        # MOST_LABELLED rows
        seen = df.select(F.col(id).alias("id"), F.col(text).alias("text")).join(F.broadcast(chosen), F.col("id") == F.col("label_id"))
        seen = written(seen.select("domain", F.array_distinct(words_of(F.col("text"))).alias("words")))
        sizes = {r.domain: r.n for r in seen.groupBy("domain").agg(F.count("*").alias("n")).collect()}
        total = [sizes.get(d, 0) for d in domains]
        if not sum(total):
            return Classifier(domains, [0.0] * len(domains), {}, {})
        has = [f"n{k}" for k in range(len(domains))]
        counts = seen.select("domain", F.explode("words").alias("word")).groupBy("word").agg(*[F.sum((F.col("domain") == d).cast("long")).alias(h) for d, h in zip(domains, has)])
        every = sum((F.col(h) for h in has), F.lit(0))
        clear = []
        for h, n in zip(has, total):
            own, rest = F.col(h) + 0.5, every - F.col(h) + 0.5
            odds = F.log(own / (n + 1.0)) - F.log(rest / (sum(total) - n + 1.0))
            clear.append(F.when((odds >= LEAST_ODDS) & (F.col(h) >= LEAST_SEEN), odds / F.sqrt(1 / own + 1 / rest)).otherwise(0.0))
        best = counts.withColumn("hash", F.xxhash64("word")).withColumn("z", F.greatest(*clear) if len(clear) > 1 else clear[0]).where(F.col("z") >= LEAST_Z)
        rows = best.orderBy(F.desc(F.round("z", 6)), "word").collect()  # as many as the labelled sample bears out
        base = [math.log((n + 1) / (sum(total) + len(total))) for n in total]
        weights = {}
        for r in rows:
            share = [(r[h] + 0.5) / (n + 1.0) for h, n in zip(has, total)]
            base = [b + math.log(1 - p) for b, p in zip(base, share)]
            weights[r.word] = [math.log(p) - math.log(1 - p) for p in share]
        return Classifier(domains, base, weights, {r.word: r.hash for r in rows})

    def probabilities(self, df: DataFrame, words: str) -> DataFrame:
        """``df`` with ``m0``, ``m1``, ...: each domain's probability in thousandths, adding up to UNIT."""
        if self.weights:
            # each word is looked up at the one slot it may have; what is found is short
            known = list(self.weights)
            size, shift, slots = _apart([self.hashes[w] for w in known])
            held = dict(zip(slots, known))
            at = lambda w: _slot(F.xxhash64(w), size, shift)
            spelled = F.split(F.lit(" ".join(held.get(i, "") for i in range(size))), " ")  # words have no space
            df = df.withColumn("found", F.array_distinct(F.filter(words, lambda w: F.get(spelled, at(w)) == w)))
            df = df.withColumn("found", F.transform("found", at))
            odds = [_summed(_literal([self.weights[held[i]][k] if i in held else 0.0 for i in range(size)], "double"), b) for k, b in enumerate(self.base)]
        else:
            df = df.withColumn("found", F.lit(None))
            odds = [F.lit(b) for b in self.base]
        df = df.withColumns({f"o{k}": o for k, o in enumerate(odds)})
        names = [f"o{k}" for k in range(len(self.base))]
        top = F.greatest(*names) if len(names) > 1 else F.col(names[0])
        df = df.withColumn("top", top).withColumns({n: F.exp(F.col(n) - F.col("top")) for n in names})
        df = df.withColumn("all", sum((F.col(n) for n in names), F.lit(0.0)))
        # cumulative rounding keeps the sum exact
        run = [F.lit(0).cast("long")]
        for k in range(len(names)):
            # never null; saying so keeps null filters, which would work it all out again, away from a join
            run.append(F.coalesce(F.round(UNIT * sum((F.col(n) for n in names[: k + 1]), F.lit(0.0)) / F.col("all")).cast("long"), F.lit(0)))
        return df.withColumns({f"m{k}": run[k + 1] - run[k] for k in range(len(names))}).drop("top", "all", "found", *names)


def _apart(hashes: list[int]) -> tuple[int, list[int], list[int]]:
    """A number of slots, a shift for each bucket of hashes and the slot of each hash, no two of which are the same."""
    size = 2 * len(hashes) + 1
    while True:
        shift, taken = [0] * len(hashes), {}
        buckets: dict[int, list[int]] = {}
        for h in hashes:
            buckets.setdefault(h % len(shift), []).append(h)
        for b, own in sorted(buckets.items(), key=lambda x: -len(x[1])):
            for d in range(size):
                places = {(h + d * ((h >> 32) % (size - 1) + 1)) % size: h for h in own}
                if len(places) == len(own) and not places.keys() & taken.keys():
                    shift[b] = d
                    taken |= places
                    break
            else:
                break
        if len(taken) == len(hashes):
            where = {h: at for at, h in taken.items()}
            return size, shift, [where[h] for h in hashes]
        size += 2


def _slot(hash: Column, size: int, shift: list[int]) -> Column:
    """The slot that ``_apart`` gave to a hash."""
    step = F.pmod(F.shiftright(hash, 32), F.lit(size - 1)) + 1
    moved = F.get(_literal(shift, "bigint"), F.pmod(hash, F.lit(len(shift))).cast("int"))
    return F.pmod(F.pmod(hash, F.lit(size)) + moved * step, F.lit(size)).cast("int")


def _literal(values: list, kind: str) -> Column:
    """An array that the optimizer folds into one literal."""
    return F.split(F.lit(" ".join(map(repr, values))), " ").cast(f"array<{kind}>")


def _summed(weights: Column, base: float) -> Column:
    return F.aggregate("found", F.lit(base), lambda s, at: s + F.get(weights, at))


def _moved(step: Column, k: int) -> Column:
    return sum((F.get(step, F.lit(j)) * F.col(f"m{j}") for j in range(k)), F.lit(0.0)) / UNIT


def _within(r: Column, most: float | None) -> Column:
    r = F.greatest(F.lit(0.0), r)
    return r if most is None else F.least(F.lit(float(most)), r)


def rate(steps: list[list[float]], most: float | None = None) -> Column:
    """The rate after these steps, from 1: each takes the domains' corrections by the document's probabilities, not below 0 nor above
    ``most``."""
    if not steps:
        return F.lit(1.0)
    every = F.array(*[F.array(*[F.lit(float(x)) for x in e]) for e in steps])
    return F.aggregate(every, F.lit(1.0), lambda r, e: _within(r - _moved(e, len(steps[0])), most))


@dataclass
class Fit:
    """Corrections of each step, and the tokens that the domains are to have and have at the fitted rates."""

    steps: list[list[float]]
    wanted: list[float]
    have: list[float] = field(default_factory=list)

    def residual(self, whole: float) -> float:
        """The largest distance from a target, as a share of the target (at least a millionth of all tokens)."""
        return max((abs(h - w) / max(w, 1e-6 * whole, 1e-9) for h, w in zip(self.have, self.wanted)), default=0.0)


@dataclass
class _At:
    """Sums at the rates after a path and one more step: the domains' tokens, the Gram matrix of the documents whose rates can move
    both ways, the potential whose slope the tokens are, and how far the step has moved the rates (squares by tokens)."""

    have: np.ndarray
    gram: np.ndarray
    potential: float
    moved: float


def _sums(members: DataFrame, path: list[list[float]], steps: list[np.ndarray], most: float | None) -> list[_At]:
    """The sums after each of several further steps, in one aggregate."""
    k, n = len(steps[0]), F.col("n_tokens") / UNIT
    before = members.withColumn("before", rate(path, most))
    tried = F.array(*[F.array(*[F.lit(float(x)) for x in step]) for step in steps])
    each = before.select("*", F.posexplode(tried).alias("which", "step"))
    points = each.withColumn("free", F.col("before") - _moved(F.col("step"), k)).withColumn("rate", _within(F.col("free"), most))
    top = F.lit(False) if most is None else F.col("free") >= most
    inside = (F.col("free") > 0) & ~top
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    potential = F.when(F.col("free") <= 0, 0.0).when(top, (most or 0.0) * F.col("free") - (most or 0.0) ** 2 / 2).otherwise(F.col("free") ** 2 / 2)
    sums = points.groupBy("which").agg(
        *[F.sum(F.col("rate") * n * F.col(f"m{j}")).alias(f"e{j}") for j in range(k)],
        *[F.sum(F.when(inside, n * F.col(f"m{i}") * F.col(f"m{j}") / UNIT).otherwise(0.0)).alias(f"g{i}_{j}") for i, j in pairs],
        F.sum(F.col("n_tokens") * potential).alias("potential"),
        F.sum(F.col("n_tokens") * (F.col("rate") - F.col("before")) ** 2).alias("moved"),
    )
    out = [_At(np.zeros(k), np.zeros((k, k)), 0.0, 0.0) for _ in steps]  # of no documents
    for found in sums.collect():
        gram = np.zeros((k, k))
        for i, j in pairs:
            gram[i, j] = gram[j, i] = found[f"g{i}_{j}"]
        out[found["which"]] = _At(np.array([found[f"e{j}"] for j in range(k)], float), gram, found["potential"], found["moved"])
    return out


def fit_rates(members: DataFrame, targets: list[float], most: float | None = None, close: float = CLOSE) -> Fit:
    """Rates from 0 to ``most`` that meet ``targets`` (tokens), or come nearest; ``members`` has ``m0``... and the ``n_tokens`` of all
    documents with these probabilities.

    Projected gradient on the squares of the domains' distances, each in units of the domain's tokens at rate 1. The steps are
    long and implicit: a step of length LONG goes along the gradient at the rates where it ends, so it can't go too far, and as the
    gradient of a document depends on its probabilities only, such a step is one correction a domain. That is found by Newton's
    method on a convex function of as many numbers as domains, each of its steps an aggregate that tries several sizes. Steps follow until every target is
    met to ``close``, or until a plain gradient step no longer moves the rates (STILL): then no rates are nearer. Domains
    without tokens can't be moved.
    """
    k = len(targets)
    fit = Fit([], list(targets))
    (start,) = _sums(members, [], [np.zeros(k)], None)
    have, whole = start.have, float(start.have.sum())
    fit.have = have.tolist()
    live, unit = have > 0, np.where(have > 0, have, 1.0)
    goal = np.where(live, np.array(targets, float), 0.0)
    squares = lambda h: float(((h - goal) ** 2 / unit).sum())
    while live.any() and Fit([], goal[live].tolist(), have[live].tolist()).residual(whole) > close:
        step = np.zeros(k)
        plain, at = _sums(members, fit.steps, [(have - goal) / unit, step], most)
        if plain.moved <= STILL**2 * whole:
            break
        for long in LONG:
            slope = lambda a, e: a.have - goal - unit * e / long  # noqa: B023, E731
            height = lambda a, e: a.potential + goal @ e + float((unit * e**2).sum()) / (2 * long)  # noqa: B023, E731
            while np.abs(slope(at, step) / unit).max() > EVEN:
                up = slope(at, step)
                way = np.linalg.solve(at.gram + np.diag(unit / long), up)
                tries = [step + size * way for size in SIZES]
                found = [(height(a, e), a, e, size) for a, e, size in zip(_sums(members, fit.steps, tries, most), tries, SIZES)]
                low, best, new, size = min(found, key=lambda f: f[0])
                if low > height(at, step) - 1e-12 * abs(height(at, step)) and np.abs(slope(best, new)).max() >= np.abs(up).max():
                    break  # nothing lower in the numbers at hand
                step, at = new, best
        if squares(at.have) >= squares(have) * (1 - 1e-9):
            break
        fit.steps.append([float(x) for x in step])
        have = at.have
        fit.have = have.tolist()
    if fit.residual(whole) > close:
        warnings.warn(f"domain targets {fit.wanted} are not met: the fitted rates give {fit.have}", stacklevel=2)
    return fit


def mix(
    df: DataFrame,
    labelled: DataFrame,
    targets: dict[str, float],
    id: str = "doc_id",
    text: str = "text",
    relative: bool = False,
    seed: int = 10,
    keep_text: bool = True,
    most: float | None = None,
) -> DataFrame:
    """``df`` (without its text, unless ``keep_text``) with ``n_tokens``, ``memberships`` (domain -> probability), ``rate`` (from 0 to
    ``most``) and ``copies``.

    ``labelled`` has doc_id and domain. ``targets`` gives each domain's share of the tokens that there are, or with
    ``relative`` the factor by which the domain's own expected tokens are to change. ``copies`` is the rate rounded up or
    down by a hash of the id, so that it is right on average. If the fit can't meet the targets it warns and says by how much.

    Null and empty texts have no tokens and the probabilities of a text without known words. Repeated rows get equal
    results; ties in the sample go by id; a document labelled with several domains trains none. Without labels all domains
    are as likely; an empty table stays empty. Names that ``df`` has already get underscores.
    """
    domains = list(targets)
    classifier = Classifier.fit(df, labelled.select("doc_id", "domain"), domains, id, text)
    own = [c for c in df.columns if keep_text or c != text]
    rows = df.select(F.struct(*own).alias("row"), F.col(id).alias("id"), words_of(F.col(text)).alias("words"))
    members = [f"m{k}" for k in range(len(domains))]
    rows = classifier.probabilities(rows.withColumn("n_tokens", F.size("words").cast("long")), "words")
    rows = written(rows.select("row", "id", "n_tokens", *members))
    points = written(rows.groupBy(*members).agg(F.sum("n_tokens").alias("n_tokens")))
    have = points.agg(*[F.coalesce(F.sum(F.col("n_tokens") * F.col(m)), F.lit(0)).alias(m) for m in members]).first()
    tokens = [float(have[m]) / UNIT for m in members]
    wanted = [w * (own_tokens if relative else sum(tokens) / sum(targets.values())) for w, own_tokens in zip(targets.values(), tokens)]
    fit = fit_rates(points, wanted, most)
    rows = rows.withColumn("rate", F.round(rate(fit.steps, most), 9))
    chance = F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(1 << 20)) / float(1 << 20)
    copies = F.floor("rate") + (chance < F.col("rate") - F.floor("rate")).cast("long")
    names = fresh(df, "n_tokens", "memberships", "rate", "copies")
    shares = F.create_map(*[x for d, m in zip(domains, members) for x in (F.lit(d), F.col(m) / UNIT)])
    return rows.select("row.*", F.col("n_tokens").alias(names[0]), shares.alias(names[1]), F.col("rate").alias(names[2]), copies.alias(names[3]))
