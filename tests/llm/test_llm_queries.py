"""Each registered opN_ query: against its SQL where it has some, else against a plain version, on the smallest tables."""

import collections
import sys
import zlib
from pathlib import Path

import duckdb
import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).parent))
import plain  # noqa: E402

from inuring.llm.queries import ORACLE_SQL, QUERIES, TARGETS  # noqa: E402
from inuring.llm.wordpiece import byte_pieces  # noqa: E402


def comparable(value):
    return "" if value is None else repr(round(value + 0.0, 6)) if isinstance(value, float) else str(value)


@pytest.fixture(scope="module")
def documents(spark, sf_dir):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_against_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark", "pages", "labels"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    df = QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    result = con.execute(ORACLE_SQL[name])
    place = {d[0]: k for k, d in enumerate(result.description)}
    assert sorted(place) == columns
    assert sorted(tuple(comparable(r[c]) for c in columns) for r in df.collect()) == sorted(tuple(comparable(r[place[c]]) for c in columns) for r in result.fetchall())


def test_token_counts_query(spark, sf_dir, documents):
    public = pytest.importorskip("public_tokenizers")
    initial, inner = (set(x) for x in byte_pieces(public.path("byte_bpe_50k.json")))
    most, known = max(map(len, initial | inner)), {}

    def pieces(word):
        if word not in known:
            n = i = 0
            while i < len(word):
                own = inner if i else initial
                i += next(k for k in range(min(most, len(word) - i), 0, -1) if word[i : i + k] in own)
                n += 1
            known[word] = n
        return known[word]

    out = {r.doc_id: (r.n_words, r.n_tokens, r.n_unknown) for r in QUERIES["op3_token_counts"](spark, sf_dir).collect()}
    assert out == {i: (len(w), sum(map(pieces, w)), 0) for i, t in documents.items() for w in [[x.encode() for x in plain.NON_SPACE.findall(t or "")]]}


def test_token_output_query(spark, sf_dir, documents):
    tokenizers, public = pytest.importorskip("tokenizers"), pytest.importorskip("public_tokenizers")
    whole, at, expected = tokenizers.Tokenizer.from_file(public.path("byte_bpe_50k.json")), 0, {}
    for i in sorted(documents):
        ids = whole.encode(documents[i] or "", add_special_tokens=False).ids + [2]
        expected[i] = at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())
        at += len(ids)
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in QUERIES["op7_token_id_output"](spark, sf_dir).collect()} == expected


def test_mixing_query(spark, sf_dir, documents):
    out = QUERIES["op10_mixing"](spark, sf_dir).collect()
    assert {r.doc_id: r.n_tokens for r in out} == {i: len(plain.NON_SPACE.findall(t or "")) for i, t in documents.items()}
    for r in out:
        assert abs(sum(r[f"p_{d}"] for d in TARGETS) - 1) < 1e-9 and r.rate >= 0 and 0 <= r.copies - np.floor(r.rate) <= 1
    p, n, rates = (np.array(x, float) for x in ([[r[f"p_{d}"] for d in TARGETS] for r in out], [r.n_tokens for r in out], [r.rate for r in out]))
    unit, whole = p.T @ n, n.sum()
    goal = np.array(list(TARGETS.values())) * whole / sum(TARGETS.values())
    off = (p.T @ (rates * n) - goal) / unit
    # met, or the nearest: a gradient step at these rates would not move them
    met = np.abs(off * unit / goal).max() <= 0.0011
    assert met or np.sqrt((n * (rates - np.maximum(0, rates - p @ off)) ** 2).sum() / whole) <= 1e-4
    same = collections.defaultdict(set)
    for r in out:
        same[documents[r.doc_id]].add((r.p_good, r.p_poor, r.p_toxic, r.rate))
    assert all(len(x) == 1 for x in same.values())
