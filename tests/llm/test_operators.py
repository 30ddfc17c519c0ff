"""Operators against brute-force versions, on small fixtures with nulls, empty and long texts, ties and repeated rows."""

import collections
import hashlib
import random
import re
import sys
import time
import zlib
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
import plain  # noqa: E402

from inuring.llm import decontam, encoding, licenses, mixing, neardup, quality, secrets, sharding, urls, wordpiece  # noqa: E402
from inuring.llm.queries import QUERIES  # noqa: E402
from inuring.llm.text import texts_of  # noqa: E402

VOCABULARY = [f"w{i}" for i in range(400)]


def frame(spark, texts, parts=3):
    """Documents with extra columns whose names clash with the operators' own."""
    rows = [(i, t, i % 2, "x") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, n_words int, labels string").repartition(parts)


EDGES = [None, "", "   ", "a", "A b", "A b", "é" * 3, "x " * 30000, "word" * 20000]


# --- 1 --------------------------------------------------------------------------------------------------------------
def place(docs, shards, seed=sharding.SEED):
    rows = [(hashlib.md5(f"{seed}:{'' if i is None else i}".encode()).hexdigest(), i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode()), s) for i, t, s in docs]
    key = lambda r: (r[0], (r[1] is not None, r[1] or 0), r[2], r[3])
    by = collections.defaultdict(list)
    for r in rows:
        by[r[4]].append(r)
    order, sizes = [], collections.defaultdict(list)
    seeded = lambda x: hashlib.md5(f"{seed}:{x}".encode()).hexdigest()
    for source in sorted(by, key=lambda x: (seeded(x or ""), x is not None)):
        sizes[len(by[source])].append(source)
    for source, own in by.items():
        alike = sizes[len(own)]
        phase = (alike.index(source) + int(seeded(len(own))[:8], 16) / 2**32) / len(alike)
        order += [((k + phase) / len(own), (source is not None, source or ""), key(r), r) for k, r in enumerate(sorted(own, key=key))]
    order.sort(key=lambda x: x[:3])
    counts, out = collections.Counter(), []
    for p, x in enumerate(order):
        shard = p * shards // len(order)
        out.append((x[3][1], x[3][2], x[3][3], shard, counts[shard]))
        counts[shard] += 1
    return sorted(out, key=str)


@pytest.mark.parametrize("slice_rows", [7, 1000])
def test_sharding(spark, slice_rows):
    rnd = random.Random(2)
    docs = [(rnd.choice([None, i, i // 2]), rnd.choice([None, "", "a", "é" * 5]), rnd.choice([None, "", "x", "y", "y", "y"])) for i in range(400)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string").repartition(5)
    out = sharding.assign_shards(df, 24, slice_rows=slice_rows).collect()
    assert sorted(((r.doc_id, r["size"], r.text_crc32, r.shard, r.slot) for r in out), key=str) == place(docs, 24)
    assert sharding.assign_shards(df.limit(0), 24).count() == 0


def test_shards_match_the_mixture(spark):
    df = spark.createDataFrame([(i, "t", "hot" if i % 3 else f"s{i % 5}") for i in range(2400)], "doc_id long, text string, source string")
    out = sharding.assign_shards(df, 24).groupBy("shard", "source").count().collect()
    for source in {r.source for r in out}:
        mine = [r["count"] for r in out if r.source == source]
        assert len(mine) == 24 and max(mine) - min(mine) <= 2


def test_small_sources_leave_the_mixture_as_it_is(spark):
    """1,200 rows of one source among 1,200 sources of one row, and sources of many sizes."""
    df = spark.createDataFrame([(i, "t", "big" if i < 1200 else f"s{i}") for i in range(2400)], "doc_id long, text string, source string")
    out = sharding.assign_shards(df, 24).where("source = 'big'").groupBy("shard").count().collect()
    assert len(out) == 24 and max(r["count"] for r in out) - min(r["count"] for r in out) <= 2
    sizes = [(k, j) for k in range(1, 60) for j in range(k)]
    df = spark.createDataFrame([(i, "t", f"s{k}") for i, (k, _) in enumerate(sizes)], "doc_id long, text string, source string")
    for r in sharding.assign_shards(df, 6).groupBy("source").pivot("shard", list(range(6))).count().fillna(0).collect():
        own = [r[str(k)] for k in range(6)]
        assert max(own) - min(own) <= 3, r


# --- 2 --------------------------------------------------------------------------------------------------------------
@pytest.mark.parametrize("trial,block", [(0, 8 << 20), (1, 60), (2, 60)])
def test_decontamination(spark, trial, block):
    rnd = random.Random(trial)
    letters = list("abcd")[: 2 + trial] + ["É"]
    items = [(i, " ".join(rnd.choice(letters) for _ in range(rnd.randint(0, 14))) if i else None) for i in range(8)]
    docs = [" ".join(rnd.choice(letters + ["zz"]) for _ in range(rnd.randint(0, 60))) for _ in range(100)] + EDGES
    found = decontam.find_matches(frame(spark, docs), spark.createDataFrame(items, "item_id long, text string"), block_bytes=block)
    rows = found.select("doc_id", "n_words_", decontam.words_hit(F.col("matches")).alias("hit"), decontam.items_hit(F.col("matches")).alias("items")).collect()
    assert {r.doc_id: (r.n_words_, r.hit, list(r["items"])) for r in rows} == plain.windows(enumerate(docs), items)


def test_passages_around_a_window(spark):
    """Passages of 8 to 12 words of long items in texts of the same words; items that differ in one word of a window."""
    rnd = random.Random(22)
    vocabulary = [f"w{k}" for k in range(40)]
    line = lambda n: " ".join(rnd.choice(vocabulary) for _ in range(n))
    items = [(k, line(rnd.choice([2, 9, 30, 120]) if k else 1)) for k in range(40)]
    items += [(k + 40, " ".join("q" if j == 7 else w for j, w in enumerate(text.split()))) for k, text in items]
    docs = []
    for _ in range(150):
        own, n = rnd.choice(items)[1].split(), rnd.randint(8, 12)
        at = rnd.randint(0, max(0, len(own) - n))
        docs.append(f"{line(rnd.randint(0, 30))} {' '.join(own[at : at + n])} {line(rnd.randint(0, 30))}")
    for some in (items, [x for x in items if len(x[1].split()) > 9]):
        found = decontam.find_matches(frame(spark, docs), spark.createDataFrame(some, "item_id long, text string"), block_bytes=3000)
        rows = found.select("doc_id", "n_words_", decontam.words_hit(F.col("matches")).alias("hit"), decontam.items_hit(F.col("matches")).alias("items")).collect()
        assert {r.doc_id: (r.n_words_, r.hit, list(r["items"])) for r in rows} == plain.windows(enumerate(docs), some)


def test_decontamination_of_repeated_rows_and_shared_names(spark):
    """Rows that repeat get equal results; items of one name count once; a null name is the empty one."""
    text = " ".join(VOCABULARY[:12])
    bench = spark.createDataFrame([("i", text), ("i", "q " + text), (None, text)], "item_id string, text string")
    df = frame(spark, [text]).union(frame(spark, [text]))
    rows = decontam.find_matches(df, bench).select(decontam.words_hit(F.col("matches")).alias("hit"), decontam.items_hit(F.col("matches")).alias("items")).collect()
    assert [(r.hit, list(r["items"])) for r in rows] == [(12, ["", "i"])] * 2


def test_longest_matches(spark):
    item = " ".join(VOCABULARY[:30])
    docs = ["q " + " ".join(VOCABULARY[5:20]) + " q " + " ".join(VOCABULARY[:12]), "q"]
    bench = spark.createDataFrame([(7, item)], "item_id long, text string")
    found = {r.doc_id: [tuple(m) for m in r.matches] for r in decontam.find_matches(frame(spark, docs), bench).collect()}
    assert found == {0: [("7", 1, 15), ("7", 17, 12)], 1: []}
    kept = decontam.decontaminate(frame(spark, docs), bench)
    assert [r.doc_id for r in kept.collect()] == [1] and kept.columns == ["doc_id", "text", "n_words", "labels"]
    assert decontam.decontaminate(frame(spark, docs), bench.limit(0)).count() == 2
    assert decontam.decontaminate(frame(spark, docs).limit(0), bench).count() == 0


def test_repeated_words_take_linear_time(spark):
    """A million equal words against an item that repeats the same word, and a line that every item has."""
    line = " ".join(f"p{k}" for k in range(12))
    items = [(0, "the " * 500)] + [(k, f"{line} " + " ".join(f"i{k}x{j}" for j in range(8))) for k in range(1, 300)]
    docs = ["the " * 1_000_000, f"x {line} y", " ".join(f"i7x{j}" for j in range(8))]
    began = time.perf_counter()
    found = decontam.find_matches(frame(spark, docs), spark.createDataFrame(items, "item_id long, text string"))
    rows = {r.doc_id: r for r in found.select("doc_id", decontam.words_hit(F.col("matches")).alias("hit"), F.size(decontam.items_hit(F.col("matches"))).alias("items")).collect()}
    assert {k: (r.hit, r["items"]) for k, r in rows.items()} == {0: (1_000_000, 1), 1: (12, 299), 2: (0, 0)}
    assert time.perf_counter() - began < 60


# --- 3 --------------------------------------------------------------------------------------------------------------
def greedy(word, initial, inner):
    n = i = 0
    while i < len(word):
        for j in range(len(word), i, -1):
            if word[i:j] in (initial if i == 0 else inner):
                break
        else:
            return -1
        n, i = n + 1, j
    return n


def test_longest_match_automaton():
    rnd = random.Random(4)
    some = lambda k, m: [bytes(rnd.choice(b"abc") for _ in range(rnd.randint(1, m))) for _ in range(k)]
    for _ in range(60):
        initial, inner = some(rnd.randint(0, 8), 5), some(rnd.randint(0, 8), 5)
        words = some(100, 25)
        got = wordpiece.Automaton(initial, inner).counts(np.frombuffer(b"".join(words), np.uint8), np.concatenate([[0], np.cumsum([len(w) for w in words])]))
        assert got.tolist() == [greedy(w, set(initial), set(inner)) for w in words]


def test_token_counts(spark):
    initial, inner = [b"a", b"ab", b"w"], [b"b", b"o", b"ord", b"rd"]
    docs = ["ab abb zz word", "wordx"] + EDGES
    out = {r.doc_id: (r.n_words_, r.n_tokens, r.n_unknown) for r in wordpiece.count_tokens(frame(spark, docs), initial, inner).collect()}
    for i, text in enumerate(docs):
        each = [greedy(w.encode(), set(initial), set(inner)) for w in plain.NON_SPACE.findall(text or "")]
        assert out[i] == (len(each), sum(1 if n < 0 else n for n in each), sum(n < 0 for n in each))


def test_long_words_take_linear_time():
    """One word of a megabyte among many short ones."""
    rnd = random.Random(3)
    initial, inner = [b"a", b"ab", b"b"], [b"a", b"b", b"ba", b"bab"]
    words = [bytes(rnd.choice(b"ab") for _ in range(rnd.randint(1, 12))) for _ in range(50_000)] + [bytes(rnd.choice(b"ab") for _ in range(1 << 20))]
    began = time.perf_counter()
    got = wordpiece.Automaton(initial, inner).counts(np.frombuffer(b"".join(words), np.uint8), np.concatenate([[0], np.cumsum([len(w) for w in words])]))
    assert time.perf_counter() - began < 20
    assert got[-200:].tolist() == [greedy(w, set(initial), set(inner)) for w in words[-200:-1]] + [long_greedy(words[-1], initial, inner)]


def long_greedy(word, initial, inner):
    n, i, most = 0, 0, max(map(len, initial + inner))
    while i < len(word):
        own = initial if i == 0 else inner
        i += next(k for k in range(most, 0, -1) if word[i : i + k] in own and i + k <= len(word))
        n += 1
    return n


# --- 4 --------------------------------------------------------------------------------------------------------------
def test_url_rules(spark):
    rows = [(1, None, "a"), (2, "", "b"), (3, "nothing", "c"), (4, "http://x.ORG/fr/ü?a", "d"), (5, "http://net", "e"), (6, "http://a.net/x#y", "e"), (7, "http://m.example.net/en/3?q", "e"), (8, "http://anet/x", "e")]
    df = spark.createDataFrame(rows + rows[-1:], "page_id int, url string, host string")
    out = {r.page_id: r for r in urls.judge_urls(df).collect()}
    assert {i: (r.host_, r.path, r.rule) for i, r in out.items()} == {
        1: ("", "", None), 2: ("", "", None), 3: ("", "", None), 4: ("x.org", "/fr/ü", "org/fr/"), 5: ("net", "", None), 6: ("a.net", "/x", "net/"), 7: ("m.example.net", "/en/3", "example.net/en/"), 8: ("anet", "/x", None),
    }
    assert out[4].verdict == "allow" and out[6].verdict == "block" and out[7].verdict == "allow"
    assert all(r.verdict in ("allow", "block") for r in out.values())
    assert urls.judge_urls(df).count() == 9 and urls.judge_urls(df.limit(0)).count() == 0


def test_url_models_on_held_out(spark):
    rnd = random.Random(1)
    rows = [(i, f"http://{rnd.choice(['alpha', 'beta', 'gamma'])}{rnd.randint(0, 99)}.example.net/{rnd.choice(['en', 'de', 'fr'])}/{rnd.randint(0, 999)}") for i in range(600)]
    out = urls.judge_urls(spark.createDataFrame(rows, "page_id int, url string"))
    held = out.where(urls.held_out(F.col("url")) & F.col("rule").isNotNull()).collect()
    right = sum((r.score >= 0) == (r.verdict == "allow") for r in held)
    assert len(held) > 50 and right >= 0.95 * len(held)


def plain_ratio(train, k, gram, n):
    """Probability of a gram's last character after the k before it, by counting over the texts each time."""
    signs = {c for t, _ in n for c in t[urls.CONTEXT :]}
    if k == 0:
        return (sum(w * t[urls.CONTEXT :].count(gram) for t, w in train) + 1) / (sum(w * (len(t) - urls.CONTEXT) for t, w in train) + len(signs) + 1)
    after = collections.Counter()
    for t, w in train:
        for i in range(urls.CONTEXT, len(t)):
            if t[i - k : i] == gram[:-1]:
                after[t[i]] += w
    shorter, all_ = plain_ratio(train, k - 1, gram[1:], n), sum(after.values())
    return (after[gram[-1]] + len(after) * shorter) / (all_ + len(after)) if all_ else shorter


def test_url_models_against_plain_counts(spark):
    """Every gram's ratio, with digits, other scripts and repeated URLs."""
    rnd = random.Random(5)
    addresses = [f"http://{rnd.choice(['ab', 'ba', 'ηλ', '中'])}{rnd.randint(0, 9)}.{rnd.choice(['net', 'org'])}/{rnd.choice(['fr', 'x'])}/{rnd.randint(0, 20)}" for _ in range(60)]
    df = spark.createDataFrame([(a, 1 + k % 2, "allow" if ".org/fr" in a else "block" if ".net" in a else None, k % 5 == 0) for k, a in enumerate(addresses)], "u string, weight int, verdict string, held boolean")
    spread = urls.grams(df, "u", ["weight", "verdict", "held"])
    times = lambda v: F.sum(F.when((F.col("verdict") == v) & ~F.col("held"), F.col("weight")).otherwise(0))
    counts = spread.groupBy("gram").agg(F.count("*").alias("n"), times("allow").alias("accepted"), times("block").alias("rejected"))
    got = {r.gram: r.ratio for r in urls.log_ratios(counts).collect()}
    spelled = [(urls.BEFORE * urls.CONTEXT + a + urls.AFTER, 1 + k % 2, ".org/fr" in a, ".net" in a, k % 5 == 0) for k, a in enumerate(addresses)]
    allow, block = ([(t, w) for t, w, a, b, h in spelled if not h and (a if k == 0 else b)] for k in (0, 1))
    every = [(t, w) for t, w, *_ in spelled]
    for gram in rnd.sample(sorted(got), 60):
        expected = np.log(plain_ratio(allow, urls.CONTEXT, gram, every)) - np.log(plain_ratio(block, urls.CONTEXT, gram, every))
        assert abs(got[gram] / 1e6 - expected) < 1e-5


def test_hot_and_repeated_urls(spark):
    """Rows of one URL, null ones among them, get one score each and all rows stay."""
    rows = [(i, None if i % 3 == 0 else "http://a.net/x" if i % 3 == 1 else f"http://b{i}.org/fr/1") for i in range(900)]
    out = urls.judge_urls(spark.createDataFrame(rows, "page_id int, url string")).collect()
    assert sorted(r.page_id for r in out) == list(range(900))
    assert len({(r.score, r.verdict) for r in out if r.page_id % 3 == 0}) == 1 and {r.verdict for r in out if r.page_id % 3 == 1} == {"block"}


# --- 5 --------------------------------------------------------------------------------------------------------------
PLAIN_RULES = (("assign", r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 12, 2, re.I | re.A), ("access", "AKIA[A-Z0-9]+", 18, 0, 0), ("hex", "[0-9a-f]+", 16, 0, 0))


def test_secrets(spark):
    rnd = random.Random(1)
    parts = ["token", "secret", "=", ":", " ", '"', "'", "AKIA", "ABCD1234", "deadbeef0123", "é", "abcdefghijkl", "Pass", "word", "api", "_", "key", "\n", ",", "0123456789abcdef", "API_KEY", "passwd", ".", "-"]
    docs = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 60))) for _ in range(800)] + EDGES + ["a" * 50000 + " token=abcdefghijklmnop", "token=secret : abcdefghijklmnop"]
    for r in secrets.scan_secrets(frame(spark, docs)).collect():
        base = [(s.start, s.kind, s.end) for s in r.secrets if s.kind in ("assign", "access", "hex")]
        expected = [(m.start(), k, n, m.end()) for k, (n, p, least, group, flags) in enumerate(PLAIN_RULES) for m in re.finditer(p, docs[r.doc_id] or "", flags) if len(m[group]) >= least]
        assert base == [(a, n, b) for a, _, n, b in sorted(expected)], docs[r.doc_id]


def test_more_secrets(spark):
    """The added rules against plain patterns, on texts of their parts."""
    rnd = random.Random(2)
    parts = ["ghp_", "gho_", "xoxb-", "xoxz-", "AIza", "eyJ", ".", "-----BEGIN ", "RSA ", "PRIVATE KEY-----", "a1B2" * 9, "cd" * 10, "_", "-", " ", "é", "\n", "AKIA", "0" * 20]
    docs = ["x ghp_" + "a1B2" * 9 + " y", "-----BEGIN RSA PRIVATE KEY-----", "eyJ" + "ab" * 20 + "." + "cd" * 10 + ".sig-x", "xoxb-" + "1" * 15 + " AIza" + "x" * 35]
    docs += ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 30))) for _ in range(600)]
    some = 0
    for r in secrets.scan_secrets(frame(spark, docs)).collect():
        expected = [(m.start(), k, rule.kind, m.end()) for k, rule in enumerate(secrets.MORE_RULES) for m in re.finditer(rule.pattern.decode(), docs[r.doc_id]) if len(m[rule.group]) >= rule.least]
        got = [(s.start, s.kind, s.end) for s in r.secrets if s.kind not in ("assign", "access", "hex")]
        assert got == [(a, n, b) for a, _, n, b in sorted(expected)], docs[r.doc_id]
        some += len(got)
    assert some > 100


def test_many_rules(spark):
    """Seventy rules, more than a machine word has bits."""
    rules = tuple(secrets.Rule(f"k{i}", f"key{i:02d}x".encode(), 0) for i in range(70))
    docs = [" ".join(f"key{i:02d}x" for i in range(70)), "key69x key68", None]
    out = {r.doc_id: [s.kind for s in r.secrets] for r in secrets.scan_secrets(frame(spark, docs), rules=rules).collect()}
    assert out == {0: [f"k{i}" for i in range(70)], 1: ["k69"], 2: []}
    assert secrets.scan_secrets(frame(spark, docs).limit(0)).count() == 0


def test_secret_segments_take_linear_time(spark):
    docs = ["eyJaaaa.bbb.cc." + "eyJ" * 350_000, "token=" * 170_000 + "abcdefghijklmnop", "ghp_" * 250_000]
    began = time.perf_counter()
    out = {r.doc_id: [(s.kind, s.start, s.end) for s in r.secrets] for r in secrets.scan_secrets(frame(spark, docs)).collect()}
    assert time.perf_counter() - began < 60
    assert out[0] == [] and out[1] == [("assign", 0, len(docs[1]))] and len(out[2]) <= 1


@pytest.mark.parametrize("pattern", [rb"a(b|cd)*e?", rb"[^a-c]x{2,3}", rb"(?:ab|a)b+\x20?", rb"\.[a\-z]{2}"])
def test_patterns_against_re(pattern):
    from inuring.llm.automaton import Dfa

    rnd = random.Random(7)
    for _ in range(300):
        data = bytes(rnd.choice(b"abcdex. -z") for _ in range(rnd.randint(0, 15)))
        anchored = Dfa([pattern], anchored=True)
        begins = [i for i in range(len(data)) if re.compile(pattern).match(data, i)]
        assert [len(data) - at for at in reversed(Dfa([pattern], backward=True).ends(data[::-1]))] == begins
        assert all(any(re.compile(pattern).fullmatch(data, a, b) for _ in [0]) for a, b in anchored.longest(data, begins))


# --- 6 --------------------------------------------------------------------------------------------------------------
def test_licenses(spark):
    rnd = random.Random(3)
    parts = ["cc", "by", "all", "rights", "reserved", "General", "public", "license", "x", "É"]
    docs = [" ".join(rnd.choice(parts) for _ in range(rnd.randint(0, 40))) for _ in range(300)] + EDGES
    for r in licenses.scan_licenses(frame(spark, docs)).collect():
        w = plain.words(docs[r.doc_id])
        expected = sorted((i, label) for phrase, label in licenses.PHRASES for k in [phrase.split()] for i in range(len(w) - len(k) + 1) if w[i : i + len(k)] == k)
        assert r.n_words_ == len(w) and [(p.start, p.label) for p in r.phrases] == expected
        assert {label for _, label in expected} <= set(r.labels_) and 0 <= r.score <= 1 and (not expected or r.score == 1)


def test_license_templates(spark):
    notice = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"
    docs = ["some text. " + notice + " and more", notice.replace("free of charge", "at no cost"), "the of to a free"]
    out = {r.doc_id: (r.labels_, r.score) for r in licenses.scan_licenses(frame(spark, docs)).collect()}
    assert out[0] == (["mit"], 1.0) and out[1][0] == [] and out[2][0] == []


def test_license_templates_against_brute_force(spark):
    """Several notices in one text, long texts with rarer licence words, and notices cut or changed."""
    rnd = random.Random(6)
    notices = [t.text for t in licenses.TEMPLATES]
    prose = "person binary files copy conditions granted the of to a and is in or met forms x y z".split()
    line = lambda n: " ".join(rnd.choice(prose) for _ in range(n))
    mit, apache, gpl, mpl, _, nc, _, bsd = notices[:8]
    docs = [f"{line(50)} {mit} {line(9)} {bsd}", f"{apache} {mpl} {bsd}", f"{mit} {nc} {gpl}", f"person binary files copy conditions granted {apache}"]
    docs += [f"{line(3000)} {' '.join(rnd.sample(notices, k))} {line(3000)}" for k in (1, 3, 9)]
    docs += [f"mit license {line(200)} {mit.replace('mit', 'x')}"]  # the key phrase is far from the notice
    for _ in range(60):
        changed = " ".join(rnd.choice(notices) for _ in range(rnd.randint(0, 3))).split()
        for _ in range(rnd.randint(0, 8)):
            if changed:
                changed[rnd.randrange(len(changed))] = rnd.choice(prose)
        docs.append(f"{line(rnd.randint(0, 30))} {' '.join(changed[rnd.randint(0, 3) :])} {line(rnd.randint(0, 30))}")
    docs += EDGES
    for r in licenses.scan_licenses(frame(spark, docs)).collect():
        w = plain.words(docs[r.doc_id])
        holds = lambda phrase: any(w[i : i + len(phrase)] == phrase for i in range(len(w)))  # noqa: B023, E731
        labels = {label for phrase, label in licenses.PHRASES if holds(phrase.split())}
        score = 1.0 if labels else 0.0
        for t in licenses.TEMPLATES:
            own = t.text.split()
            slack, standing = int(licenses.SLACK * len(own)), collections.Counter()
            where = collections.defaultdict(list)
            for i, x in enumerate(own):
                where[x].append(i)
            for p, x in enumerate(w):
                for i in where[x]:
                    standing[p - i] += 1
            for start, n in standing.items():
                score = max(score, n / len(own) if n >= 2 else 0.0)
                near = lambda key: any(w[p : p + len(key)] == key for p in range(max(0, start - slack), min(len(w), start + len(own) + slack - len(key) + 1)))  # noqa: B023, E731
                if n >= 2 and n / len(own) >= licenses.LEAST_SHARE and all(near(k.split()) for k in t.key_phrases):
                    labels.add(t.label)
        assert (r.labels_, r.score) == (sorted(labels), score), r.doc_id
        if r.doc_id < 4:
            assert labels >= ({"mit", "bsd"}, {"apache-2.0", "mpl", "bsd"}, {"mit", "cc-by-nc", "gpl"}, {"apache-2.0"})[r.doc_id]


def test_licenses_of_repeated_rows_and_empty_tables(spark):
    df = frame(spark, ["cc by", None, ""]).union(frame(spark, ["cc by"]))
    out = sorted((r.doc_id, r.n_words_, r.labels_, r.score) for r in licenses.scan_licenses(df).collect())
    assert out == [(0, 2, ["cc-by"], 1.0), (0, 2, ["cc-by"], 1.0), (1, 0, [], 0.0), (2, 0, [], 0.0)]
    assert licenses.scan_licenses(df.limit(0)).count() == 0 and "text" not in licenses.scan_licenses(df, keep_text=False).columns


# --- 7 --------------------------------------------------------------------------------------------------------------
def test_pack_round_trip():
    rnd = np.random.default_rng(1)
    counts = rnd.integers(0, 9, 50)
    values = (rnd.integers(0, 1 << 32, counts.sum(), dtype=np.uint64) >> rnd.integers(0, 32, counts.sum()).astype(np.uint64)).astype(np.uint32)
    control, data, _, _ = encoding.pack(values, counts)
    padded = -(-counts // 4) * 4
    back, out, a = encoding.unpack(control, data), [], 0
    for n, p in zip(counts, padded):
        out.append(back[a : a + n])
        a += p
    assert np.array_equal(np.concatenate(out), values)


def test_token_output(spark):
    tokenizers = pytest.importorskip("tokenizers")
    public = pytest.importorskip("public_tokenizers")
    file = public.path("byte_bpe_50k.json")
    whole = tokenizers.Tokenizer.from_file(file)
    rnd = random.Random(5)
    parts = ["a", "  ", "\n", "\t", "The", "é", " ", "　", " ", "!", "12", "'s", "don't", "<|endoftext|>", "\x85", "\x1c", "漢字", "😀", " x", ".", "​", " ", "ﬁ", "\n\n", " été"]
    docs = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 40))) for _ in range(1500)] + EDGES
    at, expected = 0, {}
    for i, text in enumerate(docs):
        ids = whole.encode(text or "", add_special_tokens=False).ids + [2]
        expected[i] = at, ids, zlib.crc32(np.array(ids, "<u4").tobytes())
        at += len(ids)
    out = encoding.token_output(frame(spark, docs, 5), file, 2, ids=True)
    assert {r.id: (r.start, list(r.tokens), r.ids_crc32) for r in out.collect()} == expected
    assert encoding.token_output(frame(spark, docs).limit(0), file, 2).count() == 0


@pytest.mark.parametrize("kind", ["long", "string"])
def test_token_files_are_in_ascending_order(spark, tmp_path, kind):
    """Files in the order of their names hold the documents in ascending order: null ids first, of either type, ids repeated."""
    import pyarrow.parquet as pq

    public = pytest.importorskip("public_tokenizers")
    rnd = random.Random(4)
    ids = [None if k % 10 == 0 else rnd.randint(-500, 500) for k in range(1000)]
    rows = [(i if i is None or kind == "long" else f"d{i}", f"text {rnd.randint(0, 99)}") for i in ids]
    df = spark.createDataFrame(rows, f"doc_id {kind}, text string").repartition(5)
    encoding.write_tokens(df, str(tmp_path / "out"), public.path("byte_bpe_50k.json"), 2)
    files = sorted((tmp_path / "out" / "tokens").glob("*.parquet"))
    found = [x for f in files for x in pq.read_table(f)["id"].to_pylist()]
    assert len(files) > 2 and found == sorted((r[0] for r in rows), key=lambda x: (x is not None, x if x is not None else 0 if kind == "long" else ""))
    assert not (tmp_path / "out" / "encoded").exists()
    back = sorted((r.start, r.n_tokens) for r in encoding.read_tokens(spark, str(tmp_path / "out")).collect())
    assert len(back) == 1000 and back[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(back, back[1:]))


# --- 8 --------------------------------------------------------------------------------------------------------------
def test_quality(spark):
    rnd = random.Random(8)
    parts = ["a b c", "the", "\n", "É", "x&&&", "|", "WORD", "some words", "\n\n", " \t", "12"]
    docs = ["".join(rnd.choice(parts) + rnd.choice([" ", "\n", " "]) for _ in range(rnd.randint(0, 120))) for _ in range(300)]
    docs += [" ".join(rnd.choice(VOCABULARY) for _ in range(80)) for _ in range(20)] + EDGES
    out = quality.quality_report(frame(spark, docs)).collect()
    got = {r.doc_id: (r.n_words_, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.kept) for r in out}
    expected = {i: plain.quality(t) for i, t in enumerate(docs)}
    assert got == {i: x[:5] + x[6:] for i, x in expected.items()}
    kept = quality.quality_filter(frame(spark, docs))
    assert sorted(r.doc_id for r in kept.collect()) == [i for i, x in expected.items() if x[6]] and "kept" not in kept.columns
    assert quality.quality_filter(frame(spark, docs).limit(0)).count() == 0


def test_quality_report_of_repeated_rows_and_empty_tables(spark):
    df = frame(spark, ["a b"]).union(frame(spark, ["a b"]))
    out = [(r.n_words_, r.word_chars, r.kept) for r in quality.quality_report(df).collect()]
    assert out == [(2, 2, False)] * 2 and quality.quality_report(df.limit(0)).count() == 0


def test_rules_are_ordered_on_what_is_left():
    """A rule whose rejections an earlier one has taken comes last, however many it has on all texts."""
    import pyarrow as pa

    texts = quality.Features(texts_of(pa.array(["a"] * 60 + ["b c"] * 20 + ["d e f"] * 20)))
    slow = lambda f: [time.sleep(0.002), f.n_words < 2][1]
    rules = (quality.Rule("same", slow), quality.Rule("short", lambda f: f.n_words < 2), quality.Rule("two", lambda f: [time.sleep(0.001), f.n_words == 2][1]))
    found = quality.greedy_order([texts], rules)
    assert [x[0] for x in found] == ["short", "two", "same"] and [round(x[2], 3) for x in found] == [0.6, 0.5, 0.0]


def test_verdict_does_not_depend_on_the_order():
    import pyarrow as pa

    texts = texts_of(pa.array(["a b " * 40, " ".join(VOCABULARY[:80]), "x&& " * 60, None]))
    first = quality.cascade(quality.Features(texts), quality.RULES)
    assert (quality.cascade(quality.Features(texts), quality.RULES[::-1]) == first).all()


# --- 9 --------------------------------------------------------------------------------------------------------------
def near_copies():
    rnd = random.Random(7)
    words = [f"v{i}" for i in range(5000)]
    base, hot, docs = [rnd.choice(words) for _ in range(150)], [rnd.choice(words) for _ in range(40)], []
    for _ in range(120):  # similarities on both sides of the threshold
        copy = list(base)
        for _ in range(rnd.randint(0, 12)):
            copy[rnd.randrange(len(copy))] = rnd.choice(words)
        docs.append(" ".join(copy))
    docs += [" ".join(hot + [rnd.choice(words) for _ in range(rnd.randint(5, 80))]) for _ in range(150)]
    docs += [" ".join(rnd.choice(words) for _ in range(rnd.randint(0, 8))) for _ in range(50)]
    docs += docs[:30] + [None, "", "  ", "a b", "A b", "a b c d e", "a b c d e"]
    rnd.shuffle(docs)
    return docs


def test_near_duplicates(spark):
    docs = near_copies()
    out = {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.near_duplicates(frame(spark, docs)).collect()}
    assert out == plain.near_groups(enumerate(docs))


def test_deduplicate(spark):
    docs = ["a b c d e f g h", "A b c d e f g h", None, "", "x y"]
    df = frame(spark, docs).union(frame(spark, docs[:1]))
    assert sorted(r.doc_id for r in neardup.deduplicate(df).collect()) == [0, 2, 3, 4]


def test_near_duplicates_with_null_ids(spark):
    """Near copies without ids are linked, and bridge others; ids may repeat and may be strings."""
    w = [f"u{k}" for k in range(60)]
    chain = [" ".join(w[k : k + 50]) for k in (0, 3, 6)]
    other = " ".join(f"x{k}" for k in range(50))
    rows = [("d5", chain[0], 1), (None, chain[1], 2), (None, chain[1] + " ", 3), ("d2", chain[2], 4), ("d2", other, 5), ("d9", other, 6), (None, None, 7), (None, "", 8), ("d7", " ", 9), ("d7", " ", 10), ("d1", "q r s", 11), ("d1", "q r s", 12)]
    df = spark.createDataFrame(rows, "doc_id string, text string, mark int").repartition(3)
    out = sorted((str(r.doc_id), r.n_shingles, r.component_id) for r in neardup.near_duplicates(df).collect())
    assert out == sorted([("d5", 46, "d2"), ("None", 46, "d2"), ("None", 46, "d2"), ("d2", 46, "d2"), ("d2", 46, "d2"), ("d9", 46, "d2"), ("None", 0, None), ("None", 0, None), ("d7", 0, "d7"), ("d7", 0, "d7"), ("d1", 1, "d1"), ("d1", 1, "d1")])
    kept = sorted(r["mark"] for r in neardup.deduplicate(df).collect())
    assert [k if k not in (11, 12) else 11 for k in kept] == [4, 5, 7, 8, 9, 10, 11] and neardup.deduplicate(df).columns == df.columns


def test_near_duplicates_of_an_empty_table(spark):
    df = frame(spark, ["a"]).limit(0)
    assert neardup.near_duplicates(df).count() == 0 and neardup.deduplicate(df).count() == 0


def test_large_nodes_branch_on(spark, monkeypatch):
    """Bounds so low that nodes branch below the usual depth and hot classes are dealt to several tasks."""
    monkeypatch.setattr(neardup, "SMALL", 4)
    monkeypatch.setattr(neardup, "MOST_TOGETHER", 40)
    monkeypatch.setattr(neardup, "LAST_DEPTH", 5)
    monkeypatch.setattr(neardup, "PAIRS_A_TASK", 3)
    docs = near_copies()
    out = {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.near_duplicates(frame(spark, docs)).collect()}
    assert out == plain.near_groups(enumerate(docs))


def test_common_counts():
    rnd = np.random.default_rng(3)
    sets = [[np.unique(rnd.integers(0, 300, rnd.integers(0, 200))) for _ in range(n)] for n in (20, 15)]
    assert (neardup.common_counts(*sets) == np.array([[len(set(x) & set(y)) for y in sets[1]] for x in sets[0]])).all()


# --- 10 -------------------------------------------------------------------------------------------------------------
def labelled_corpus(spark):
    rnd = random.Random(10)
    docs, domains = [], []
    for i in range(600):
        kind = ("good", "good", "poor", "toxic")[i % 4]
        text = [rnd.choice(VOCABULARY) for _ in range(rnd.randint(20, 60))]
        if kind != "good":
            text += rnd.sample([f"{kind}{k}" for k in range(4)], 2)
        docs.append(" ".join(text))
        domains.append(kind)
    labels = spark.createDataFrame([(i, d) for i, d in enumerate(domains) if i % 2 == 0 or i % 5 == 0], "doc_id long, domain string")
    return docs, domains, labels


def test_mixing_meets_targets(spark):
    docs, domains, labels = labelled_corpus(spark)
    targets = {"good": 0.9, "poor": 0.08, "toxic": 0.02}
    out = mixing.mix(frame(spark, docs), labels, targets).collect()
    total = sum(r.n_tokens for r in out)
    for d, share in targets.items():
        assert abs(sum(r.rate * r.n_tokens * r.memberships[d] for r in out) / total - share) < 0.01
    held = [r for r in out if r.doc_id % 2 and r.doc_id % 5]
    right = sum(max(r.memberships, key=r.memberships.get) == domains[r.doc_id] for r in held)
    assert right >= 0.95 * len(held) and all(r.rate >= 0 and abs(r.copies - r.rate) < 1 for r in out)


def test_classifier_keeps_every_clear_word(spark):
    """More clear words than 400, most of them of one domain, against plain naive Bayes over all of them."""
    rnd = random.Random(12)
    kinds = ["good"] * 300 + ["poor"] * 300 + ["toxic"] * 12
    own = {"poor": [f"junk{k}" for k in range(500)], "toxic": [f"bad{k}" for k in range(10)]}
    docs = [" ".join(rnd.sample(VOCABULARY, 30) + rnd.sample(own["poor"], {"good": 16, "poor": 200, "toxic": 0}[d]) + rnd.sample(own["toxic"], 6 if d == "toxic" else 0)) for d in kinds]
    labels = spark.createDataFrame(list(enumerate(kinds)), "doc_id long, domain string")
    domains, total = ["good", "poor", "toxic"], {"good": 300, "poor": 300, "toxic": 12}
    held = {w: [0, 0, 0] for d in docs for w in d.split()}
    for d, kind in zip(docs, kinds):
        for w in set(d.split()):
            held[w][domains.index(kind)] += 1
    clear = {}
    for w, n in held.items():
        for k, d in enumerate(domains):
            a, b = n[k] + 0.5, sum(n) - n[k] + 0.5
            odds = np.log(a / (total[d] + 1)) - np.log(b / (612 - total[d] + 1))
            if n[k] >= mixing.LEAST_SEEN and odds >= mixing.LEAST_ODDS and odds / np.sqrt(1 / a + 1 / b) >= mixing.LEAST_Z:
                clear[w] = [(n[j] + 0.5) / (total[e] + 1) for j, e in enumerate(domains)]
    assert len(clear) > 450
    out = {r.doc_id: r.memberships for r in mixing.mix(frame(spark, docs), labels, dict.fromkeys(domains, 1.0), relative=True).collect()}
    for i, d in enumerate(docs):
        odds = np.array([np.log((total[e] + 1) / 615) + sum(np.log(p[k] if w in d.split() else 1 - p[k]) for w, p in clear.items()) for k, e in enumerate(domains)])
        share = np.exp(odds - odds.max())
        assert np.allclose([out[i][e] for e in domains], share / share.sum(), atol=0.0011)
        assert kinds[i] != "toxic" or out[i]["toxic"] > 0.5


def plain_fit(p, n, targets, most=np.inf, steps=200_000):
    """Accelerated projected gradient on relative squares with steps of one, long past the last change."""
    rate, at_one = np.ones(len(n)), p.T @ n
    unit, before = np.where(at_one > 0, at_one, 1), rate
    for k in range(steps):
        ahead = rate + k / (k + 3) * (rate - before)
        before, rate = rate, np.clip(ahead - p @ ((p.T @ (ahead * n) - targets) / unit), 0, most)
    return p.T @ (rate * n)


@pytest.mark.parametrize("most", [None, 1.0, 1.5])
@pytest.mark.parametrize("targets", [(60.0, 35.0, 1.0), (50.0, 20.0, 15.0), (70.0, 0.0, 0.0)])
def test_rates_against_plain_descent(spark, targets, most):
    rows = [(900, 100, 0, 50), (100, 800, 100, 30), (0, 0, 1000, 20), (500, 0, 500, 5)]
    points = spark.createDataFrame(rows, "m0 long, m1 long, m2 long, n_tokens long")
    fit = mixing.fit_rates(points, list(targets), most)
    p, n = np.array([r[:3] for r in rows]) / 1000, np.array([r[3] for r in rows], float)
    plain_have, unit = plain_fit(p, n, np.array(targets), most or np.inf, 20_000), p.T @ n
    squares = lambda have: ((np.array(have) - targets) ** 2 / unit).sum()
    assert squares(fit.have) <= 1.001 * squares(plain_have) + 1e-4
    got = {r.n_tokens: r.r for r in points.select("n_tokens", mixing.rate(fit.steps, most).alias("r")).collect()}
    assert all(0 <= r <= (most or np.inf) for r in got.values()) and np.allclose(p.T @ (n * [got[k] for k in n]), fit.have, atol=1e-6)


@pytest.mark.parametrize("most", [None, 1.0])
def test_fit_of_the_pipeline_is_the_nearest(spark, most):
    """The pipeline's factors over all documents of a larger corpus: squares within a hundredth of a long plain run."""
    sf_dir, factors = "/root/testdata/sf0.01", np.array([1.0, 1.0, 0.01])
    docs, labels = (spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in ("documents", "labels"))
    out = mixing.mix(docs, mixing.label_domains(labels), dict(zip(("good", "poor", "toxic"), factors)), relative=True, keep_text=False, most=most).collect()
    p, n = np.array([[r.memberships[d] for d in ("good", "poor", "toxic")] for r in out]), np.array([r.n_tokens for r in out], float)
    rates, unit = np.array([r.rate for r in out]), p.T @ n
    goal = factors * unit
    squares = lambda have: ((have - goal) ** 2 / unit).sum()
    nearest = plain_fit(p, n, goal, most or np.inf, 30_000)
    assert (rates >= 0).all() and (most is None or (rates <= most).all())
    met = np.abs(p.T @ (rates * n) / goal - 1).max() <= mixing.CLOSE * 1.01
    assert met or squares(p.T @ (rates * n)) <= 1.01 * squares(nearest) + 1e-3


def test_unreachable_targets_are_reported(spark):
    points = spark.createDataFrame([(500, 500, 100)], "m0 long, m1 long, n_tokens long")
    with pytest.warns(UserWarning, match="not met"):
        fit = mixing.fit_rates(points, [90.0, 10.0])
    assert np.allclose(fit.have, [50, 50], atol=0.5) and fit.residual(100.0) > 1


def test_mixing_takes_toxic_text_out(spark):
    """The factors of the pipeline, the rates' own and those of the rounded copies. Good documents have a toxic probability of a
    hundredth all alike here, which no rates can take out without them."""
    docs, domains, labels = labelled_corpus(spark)
    factors = {"good": 1.0, "poor": 1.0, "toxic": 0.01}
    out = mixing.mix(frame(spark, docs), labels, factors, relative=True).collect()
    for d, factor in factors.items():
        before = sum(r.n_tokens * r.memberships[d] for r in out)
        assert abs(sum(r.rate * r.n_tokens * r.memberships[d] for r in out) / before - factor) < 0.01
        assert abs(sum(r.copies * r.n_tokens * r.memberships[d] for r in out) / before - factor) < 0.03


def test_mixing_with_clashing_names_repeats_and_double_labels(spark):
    docs, domains, labels = labelled_corpus(spark)
    names = ("rate", "copies", "memberships", "n_tokens", "row", "words", "found", "m0")
    df = spark.createDataFrame([(i, t, *names) for i, t in enumerate(docs)] + [(None, docs[0], *names), (0, docs[0], *names)], f"doc_id long, text string, {', '.join(f'{n} string' for n in names)}")
    both = labels.union(labels.where("domain = 'toxic'").limit(3).selectExpr("doc_id", "'good'"))
    out = mixing.mix(df, both, {"good": 0.9, "poor": 0.08, "toxic": 0.02}).collect()
    assert len(out) == len(docs) + 2 and all(r.rate == "rate" and r.copies == "copies" and r.m0 == "m0" for r in out)
    first = [(r.n_tokens_, r.memberships_, r.rate_, r.copies_) for r in out if r.doc_id == 0]
    assert len(first) == 2 and first[0] == first[1] == next((r.n_tokens_, r.memberships_, r.rate_, first[0][3]) for r in out if r.doc_id is None)
    twice = {r.doc_id for r in both.groupBy("doc_id").count().where("count > 1").collect()}
    plain_fit = mixing.mix(df, both.where(~F.col("doc_id").isin(*twice)), {"good": 0.9, "poor": 0.08, "toxic": 0.02}).collect()
    assert {r.doc_id: r.memberships_ for r in plain_fit} == {r.doc_id: r.memberships_ for r in out}


def test_mixing_edges(spark):
    none = spark.createDataFrame([], "doc_id long, domain string")
    out = mixing.mix(frame(spark, EDGES), none, {"a": 0.5, "b": 0.5}).collect()
    assert len(out) == len(EDGES) and all(r.memberships == {"a": 0.5, "b": 0.5} for r in out)
    assert mixing.mix(frame(spark, EDGES).limit(0), none, {"a": 1.0}).count() == 0


# --- queries --------------------------------------------------------------------------------------------------------
def test_queries_on_the_small_tables(spark, sf_dir):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    two = {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in QUERIES["op2_decontamination"](spark, sf_dir).collect()}
    assert two == {i: (n, h, len(x), plain.digest(x), h > 0) for i, (n, h, x) in plain.windows(docs.items(), items).items()}
    eight = {r.doc_id: tuple(r)[1:] for r in QUERIES["op8_quality_rules"](spark, sf_dir).collect()}
    assert eight == {i: plain.quality(t) for i, t in docs.items()}
    nine = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in QUERIES["op9_minhash_near_dedup"](spark, sf_dir).collect()}
    assert nine == {i: (n, c, i == c) for i, (n, c) in plain.near_groups(docs.items()).items()}
