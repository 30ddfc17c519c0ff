"""Repeated strings, periodic runs and source divergence against brute force."""

import collections
import hashlib
import random
import re
import string
import sys
import threading
import zlib
from fractions import Fraction
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
import plain  # noqa: E402

from inuring.llm import divergence, periodic, repeats  # noqa: E402
from inuring.llm.queries import QUERIES, planted  # noqa: E402
from inuring.llm.text import NON_SPACE, texts_of  # noqa: E402

EDGES = [None, "", "   ", "a", "A b", "A b", "é" * 3, "x " * 3000, "word" * 2000, "é" * 700]
ROWS = "doc_id long, text string, removed int, runs string"


def frame(spark, texts, parts=3):
    """Documents with extra columns whose names clash with the operators' own."""
    return spark.createDataFrame([(i, t, 7, "x") for i, t in enumerate(texts)], ROWS).repartition(parts)


# --- 11 -------------------------------------------------------------------------------------------------------------
def spans_by_force(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = collections.Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        covered, spans = np.zeros(len(d) + 1, bool), []
        for i in range(len(d) - length + 1):
            if seen[d[i : i + length]] > 1:
                covered[i : i + length] = True
        for i in range(len(d)):
            if covered[i] and (i == 0 or not covered[i - 1]):
                spans.append([i, i])
            if covered[i]:
                spans[-1][1] = i + 1
        out.append([tuple(s) for s in spans])
    return out


def prose(rnd, n):
    return "".join(rnd.choice(string.ascii_lowercase + "  é") for _ in range(n))


@pytest.mark.parametrize("seed", [1, 2])
def test_matching_statistics(seed):
    rnd = random.Random(seed)
    for _ in range(60):
        base = ["".join(rnd.choice("ab"[: rnd.randint(1, 2)]) for _ in range(rnd.randint(1, 60))) for _ in range(4)]
        strings = ["".join(rnd.choice(base)[rnd.randint(0, 5) : rnd.randint(6, 60)] for _ in range(rnd.randint(0, 6))) for _ in range(rnd.randint(1, 6))]
        texts = texts_of(pa.array(strings))
        index = repeats.RunIndex(texts.data, texts.bounds)
        found = index.matching_statistics()
        assert index.lengths.sum() == sum(map(len, strings))
        for d, x in enumerate(strings):
            for i in range(len(x)):
                best = 0
                for e, y in enumerate(strings):
                    for j in range(len(y)):
                        if (d, i) != (e, j):
                            k = 0
                            while i + k < len(x) and j + k < len(y) and x[i + k] == y[j + k]:
                                k += 1
                            best = max(best, k)
                assert found[index.bounds[d] + i] == best


def corpus(rnd):
    passages = [prose(rnd, n) for n in (260, 399, 400, 401, 900, 3000)]
    texts = []
    for _ in range(60):
        parts = [prose(rnd, rnd.randint(0, 600))]
        for _ in range(rnd.randint(0, 2)):
            p = rnd.choice(passages)
            a = rnd.randint(0, len(p) // 3)
            parts += [p[a : a + rnd.randint(200, len(p))], prose(rnd, rnd.randint(0, 300))]
        texts.append("".join(parts))
    return texts + texts[:3] + [texts[5] + "!"] + EDGES + [prose(rnd, 300) * 2, "-" * 450, "ab" * 260 + prose(rnd, 90), prose(rnd, 50) + "-" * 399]


@pytest.mark.parametrize("crowd,step,index_bytes", [(1024, 1 << 20, 1 << 20), (2, 1 << 20, 1 << 20), (3, 1500, 2000)])
def test_repeats(spark, crowd, step, index_bytes):
    """The usual bounds; crowded anchors that are halved over and over; sections and indexes of a few texts."""
    texts = corpus(random.Random(crowd))
    found = repeats.find_repeats(frame(spark, texts), derive=lambda text, removed: {"left": repeats.kept_bytes(text, removed)}, crowd=crowd, step=step, index_bytes=index_bytes)
    assert found.columns == ["doc_id", "text", "removed", "runs", "removed_", "left"]
    rows = {r.doc_id: r for r in found.collect()}
    expected = spans_by_force(texts, 400)
    for i, t in enumerate(texts):
        assert [tuple(s) for s in rows[i]["removed_"]] == expected[i], i
        data = (t or "").encode()
        inside = {k for a, b in expected[i] for k in range(a, b)}
        assert bytes(rows[i]["left"]) == bytes(c for k, c in enumerate(data) if k not in inside)


def test_crowded_passage(spark):
    """A passage below the length in every text, with and without a common word after it."""
    rnd = random.Random(5)
    passage = prose(rnd, 370)
    texts = [prose(rnd, 200) + passage + ("z" * 20 if i % 3 == 0 else "") + prose(rnd, 200) for i in range(90)]
    texts += ["w" * 35 + passage + prose(rnd, 100) for _ in range(20)]
    rows = {r.doc_id: [tuple(s) for s in r["removed_"]] for r in repeats.find_repeats(frame(spark, texts), crowd=8).collect()}
    assert [rows[i] for i in range(len(texts))] == spans_by_force(texts, 400)
    assert sum(map(bool, rows.values())) >= 20


def test_repeats_of_few_rows(spark):
    df = frame(spark, [])
    assert repeats.find_repeats(df).count() == 0
    text = prose(random.Random(9), 500)
    df = spark.createDataFrame([(None, text, None), (None, text, None), (1, None, 2)], "doc_id long, text string, text_key int")
    rows = repeats.find_repeats(df, keep_text=False)
    assert rows.columns == ["doc_id", "text_key", "removed"]
    n = len(text.encode())
    assert sorted([tuple(s) for s in r.removed] for r in rows.collect()) == [[], [(0, n)], [(0, n)]]
    with pytest.raises(ValueError):
        repeats.find_repeats(df, length=255)


def test_two_threads(spark):
    """Each operator removes its own tables, and none of another that runs beside it."""
    texts, out = corpus(random.Random(4)), {}

    def run(k):
        out[k] = sorted((r.doc_id, [tuple(s) for s in r["removed_"]]) for r in repeats.find_repeats(frame(spark, texts)).collect())

    threads = [threading.Thread(target=run, args=(k,)) for k in range(2)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert out[0] == out[1] == list(enumerate(spans_by_force(texts, 400)))


# --- 12 -------------------------------------------------------------------------------------------------------------
def runs_by_force(w):
    found = {}
    for q in range(1, len(w) // 3 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j > i and j - i + q >= max(24, 3 * q):
                found.setdefault((i, j - i + q), q)
            i = j + 1
    return sorted((s, n, q) for (s, n), q in found.items())


def periodic_text(rnd):
    w = []
    while rnd.random() < 0.85:
        if rnd.random() < 0.5:
            w += [rnd.choice("abcdefgh"[: rnd.randint(1, 8)]) for _ in range(rnd.randint(0, 30))]
        else:
            p = [rnd.choice("abcdef") for _ in range(rnd.randint(1, 25))]
            w += (p * 8)[: rnd.randint(1, len(p) * 8)]
    return w


def collapsed_by_force(w, found):
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def test_periodic_runs(spark):
    rnd = random.Random(1)
    texts = [rnd.choice([" ", "\t", "  \n"]).join(periodic_text(rnd)) for _ in range(300)] + EDGES + [" ".join(["a", "b", "c"] * 20000), " é" * 23, "é " * 24]
    out = periodic.collapse_runs(frame(spark, texts))
    assert out.columns == ["doc_id", "text", "removed", "runs", "runs_", "collapsed"]
    rows = {r.doc_id: r for r in out.collect()}
    for i, t in enumerate(texts):
        w = plain.NON_SPACE.findall(t or "")
        found = runs_by_force(w) if len(w) < 10000 else [(0, len(w), 3)]
        assert [tuple(r) for r in rows[i]["runs_"]] == found, t
        assert rows[i].collapsed == collapsed_by_force(w, found)
    assert periodic.collapse_runs(frame(spark, texts).limit(0)).count() == 0


def test_periods_of_every_size():
    """Runs of exactly three periods, at every offset of the grid."""
    for q in [*range(1, 40), 63, 64, 65, 127, 128, 129]:
        for shift in range(0, 2 * q, max(1, q // 5)):
            n = max(24, 3 * q)
            w = [f"x{i}" for i in range(shift)] + [f"p{i % q}" for i in range(n)] + ["end"]
            texts = texts_of(pa.array([" ".join(w), " ".join(w[1:])]))
            words = texts.words(NON_SPACE)
            start, length, period = periodic.runs(words)
            assert (start[0], length[0], period[0]) == (shift, n, q)
            assert len(start) == (2 if shift else 1 + (n - 1 >= max(24, 3 * q)))


def test_planted_text(spark):
    texts = [None, "", "a", "a b\tc  d e f g h", " ".join(f"w{i}" for i in range(500))]
    df = spark.createDataFrame([(i, texts[i % 5]) for i in range(400)], "doc_id long, text string")
    for r in df.select("doc_id", "text", planted(F.col("doc_id"), F.col("text")).alias("out")).collect():
        w, h = plain.NON_SPACE.findall(r.text or ""), zlib.crc32(str(r.doc_id).encode())
        if h % 10 or not w:
            assert r.out == r.text
        else:
            g, n = h // 10, len(w)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            assert r.out == " ".join(w[i] if i < a else w[a + (i - a) % p] for i in range(n))


def test_periodic_query(spark, sf_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = {r.doc_id: r for r in QUERIES["op12_periodic_runs"](spark, sf_dir).collect()}
    assert set(rows) == set(texts)
    for i, t in texts.items():
        w, h = plain.NON_SPACE.findall(t or ""), zlib.crc32(str(i).encode())
        if h % 10 == 0 and w:
            a = h // 10 % len(w)
            p = 1 + (len(w) - a) // (3 + h // 10 % 8)
            w = [w[k] if k < a else w[a + (k - a) % p] for k in range(len(w))]
        found = runs_by_force(w)
        best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None,) * 3)
        expected = (len(found), *best, 1000 * best[1] // best[2] if found else None)
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in sorted(found, key=lambda r: (r[0], r[2])))
        sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
        r = rows[i]
        assert (r.n_runs, r.start, r.length, r.period, r.exponent_milli, r.runs_sha256, r.collapsed_sha256) == (*expected, sha(lines), sha(collapsed_by_force(w, found)))


# --- 13 -------------------------------------------------------------------------------------------------------------
def divergence_by_force(rows, least, top):
    term = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
    docs, n = collections.Counter(), collections.Counter()
    groups = collections.defaultdict(set)
    for text, lang, source in rows:
        lang, source, found = lang or "", source or "", term.findall(plain.lower(text))
        groups[lang].add(source)
        docs.update((lang, t) for t in set(found))
        n.update((lang, source, t) for t in found)
    out = []
    for lang, sources in groups.items():
        kept = [t for (x, t), k in docs.items() if x == lang and k >= least]
        share = lambda c: {t: 1 + 10**9 * (c[t] + 2) // (sum(c.values()) + 2 * len(kept)) for t in kept}
        counts = {s: {t: n[lang, s, t] for t in kept} for s in sources}
        p = {s: share(c) for s, c in counts.items()}
        q = share({t: sum(counts[s][t] for s in sources) for t in kept})
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in sources:
            pairs = [(o, sum(f(p[s][t], p[o][t]) for t in kept)) for o in sources if o != s]
            terms = [(t, f(p[s][t], q[t])) for t in kept if counts[s][t] and p[s][t] > q[t]]
            for part, items, most in (("pair", pairs, None), ("term", terms, top)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, value, k) for k, (item, value) in enumerate(items[:most], 1)]
    return sorted(out)


@pytest.mark.parametrize("least", [1, 3, 1000])
def test_divergence(spark, least):
    rnd = random.Random(least)
    words = ["a", "B", "éa", "Éa", "z9z", "ſ", "中文", "x-y"] + [f"w{chr(97 + i)}" for i in range(20)]
    rows = [(" ".join(rnd.choice(words) for _ in range(rnd.randint(0, 30))), rnd.choice(["en", "de", None, ""]), rnd.choice(["s1", "s2", "S", "é", None])) for _ in range(150)]
    rows += rows[:20] + [(None, "en", "s1"), ("123 --", "fr", "only"), (None, "it", "x"), ("a", "it", "y")]
    df = spark.createDataFrame([(*r, 1, "t") for r in rows], "text string, lang string, source string, value int, term string").repartition(5)
    out = divergence.source_divergence(df, least_docs=least, top=4)
    assert out.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, out.collect())) == divergence_by_force(rows, least, 4)
    assert divergence.source_divergence(df.limit(0)).count() == 0


def test_share_of_large_counts(spark):
    """Three digits at a time give the same as whole numbers, up to 9e15."""
    rnd = random.Random(3)
    rows = []
    for _ in range(200):
        total = rnd.choice([0, 1, 10**6, 10**12, 8 * 10**15])
        kept = rnd.randint(1, 10**6)
        rows.append((rnd.randint(0, total), total, kept))
    df = spark.createDataFrame(rows, "n long, total long, kept long")
    for r in df.withColumn("p", divergence.smoothed(F.col("n"), F.col("total"), F.col("kept"))).collect():
        assert r.p == 1 + 10**9 * (r.n + 2) // (r.total + 2 * r.kept)
