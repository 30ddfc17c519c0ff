"""Secret scans: all rules compiled into one deterministic automaton that reads each byte once.

The combined automaton tells which rules match somewhere in a segment of text (segments end where every state falls back
to the start, so no match crosses them). Segments with a match are rare; there the rule's own automata give the spans: one
reads backward and finds where matches begin, one reads each match from there to its last end. Both are linear.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from inuring.llm.automaton import Dfa
from inuring.llm.text import Texts, add_columns, fresh, list_array


@dataclass(frozen=True)
class Rule:
    """Matches of a byte pattern, leftmost-longest without overlap; those whose group has fewer characters are dropped."""

    kind: str
    pattern: bytes
    least: int
    group: int = 0


#: ``hex`` counts in the pattern, which gives the same spans as a filter on maximal runs and fewer candidates.
BASE_RULES = (
    Rule("assign", rb"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 12, 2),
    Rule("access", rb"AKIA[A-Z0-9]+", 18),
    Rule("hex", rb"[0-9a-f]{16,}", 16),
)
MORE_RULES = (
    Rule("github", rb"gh[pousr]_[A-Za-z0-9]+", 40),
    Rule("slack", rb"xox[abprs]-[A-Za-z0-9-]+", 20),
    Rule("google", rb"AIza[A-Za-z0-9_-]+", 39),
    Rule("jwt", rb"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 40),
    Rule("private_key", rb"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0),
)
RULES = BASE_RULES + MORE_RULES


@lru_cache(maxsize=8)
def compiled(rules: tuple[Rule, ...]) -> tuple[Dfa, tuple[tuple[Dfa, Dfa], ...]]:
    """The automaton of all rules together, and for each rule one that reads backward and an anchored one."""
    return Dfa([r.pattern for r in rules]), tuple((Dfa([r.pattern], backward=True), Dfa([r.pattern], anchored=True)) for r in rules)


def find_spans(texts: Texts, rules: tuple[Rule, ...], together: Dfa, alone: tuple[tuple[Dfa, Dfa], ...]) -> list[tuple[int, int, int, int]]:
    """(text, start, rule, end) in code points of each text, in that order."""
    data = texts.data
    cut = np.unique(np.concatenate([np.flatnonzero(together.resets[data]), texts.bounds[texts.bounds < len(data)], [len(data)]]))
    starts, ends = cut[:-1], cut[1:]
    bits = together.scan(data, starts, ends)
    out = []
    for i in np.flatnonzero(bits.any(axis=1)):
        segment = data[starts[i] : ends[i]].tobytes()
        doc = int(np.searchsorted(texts.bounds, starts[i], side="right")) - 1
        for r, rule in enumerate(rules):
            if int(bits[i, r // 64]) >> r % 64 & 1:
                backward, forward = alone[r]
                begins = [len(segment) - at for at in reversed(backward.ends(segment[::-1]))]
                for a, b in forward.longest(segment, begins):
                    if not rule.least or len(re.fullmatch(rule.pattern, segment[a:b])[rule.group]) >= rule.least:
                        out.append((doc, int(starts[i]) + a, r, int(starts[i]) + b))
    points = {}
    for doc in {x[0] for x in out}:
        lead = np.cumsum((data[texts.bounds[doc] : texts.bounds[doc + 1]] & 0xC0) != 0x80)
        points[doc] = np.concatenate([[0], lead])
    return sorted((d, int(points[d][a - texts.bounds[d]]), r, int(points[d][b - texts.bounds[d]])) for d, a, r, b in out)


def scan_secrets(df: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES, name: str = "secrets", keep_text: bool = True) -> DataFrame:
    """``df`` (without its text, unless ``keep_text``) with an array of (kind, start, end) of the secrets in the whole text: code points, end exclusive, by start and
    then in the order of the rules.

    Null and empty texts have an empty array. Each row stands for itself, so repeated rows get equal arrays; an empty
    table stays empty. If ``df`` has the name already, it gets an underscore. No shuffle.
    """
    automata = df.sparkSession.sparkContext.broadcast(compiled(rules))  # as large as the rules make it, whatever the data
    (name,) = fresh(df, name)
    kinds = np.array([r.kind for r in rules])

    def spans(texts: Texts, _) -> list:
        found = np.array(find_spans(texts, rules, *automata.value), np.int64).reshape(-1, 4)
        values = pa.StructArray.from_arrays([pa.array(kinds[found[:, 2]], pa.string()), pa.array(found[:, 1]), pa.array(found[:, 3])], names=["kind", "start", "end"])
        return [list_array(np.bincount(found[:, 0], minlength=len(texts)), values)]

    span = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
    return add_columns(df, text, [T.StructField(name, T.ArrayType(span))], spans, drop=() if keep_text else (text,))
