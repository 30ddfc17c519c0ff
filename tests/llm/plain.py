"""Brute-force versions that the operators are held against."""

import collections
import hashlib
import re

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
NON_SPACE = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def words(text):
    return WORD.findall(lower(text))


def windows(docs, items, n=10):
    """By document: words, words hit, items hit."""
    held = collections.defaultdict(set)
    for name, text in items:
        w = words(text)
        size = min(n, len(w))
        for i in range(len(w) - size + 1 if size else 0):
            held[tuple(w[i : i + size])].add(name)
    out = {}
    for key, text in docs:
        w, hit, names = words(text), set(), set()
        for size in {len(k) for k in held}:
            for i in range(len(w) - size + 1):
                if tuple(w[i : i + size]) in held:
                    hit |= set(range(i, i + size))
                    names |= held[tuple(w[i : i + size])]
        out[key] = len(w), len(hit), sorted(map(str, names))
    return out


def shingles(text, n=5):
    w = NON_SPACE.findall(lower(text))
    return {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def near_groups(docs, least=75):
    """By document: the size of its set and the smallest id reachable."""
    docs = list(docs)
    sets, parent = {i: shingles(t) for i, t in docs}, {i: i for i, _ in docs}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    inverted = collections.defaultdict(list)
    for i in sorted(sets):
        for j, k in collections.Counter(j for s in sets[i] for j in inverted[s]).items():
            if 100 * k >= least * (len(sets[i]) + len(sets[j]) - k):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
        for s in sets[i]:
            inverted[s].append(i)
    return {i: (len(sets[i]), find(i)) for i in sets}


def quality(text):
    text = text or ""
    w = NON_SPACE.findall(text)
    lines = [x for x in text.split("\n") if NON_SPACE.search(x)]
    found = collections.Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    again = {k for i in range(len(w) - 2) if found[tuple(w[i : i + 3])] > 1 for k in (i, i + 1, i + 2)}
    symbols = sum(text.count(c) for c in "#*$%&|<>")
    chars = sum(map(len, w))
    upper, letters = len(re.findall("[A-Z]", text)), len(re.findall(r"[A-Za-z\u0080-\U0010ffff]", text))
    base = len(w) < 50 or 100 * len(again) > 50 * len(w)
    dup = len(lines) - len(set(lines))
    bad = base or 10 * symbols > 3 * len(w) or 2 * dup > len(lines) or chars < 2 * len(w) or chars > 20 * len(w) or 2 * upper > letters
    return len(w), chars, symbols, dup, len(again), base, not bad


def digest(names):
    return hashlib.sha256(",".join(names).encode()).hexdigest()
