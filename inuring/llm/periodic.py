"""Runs of periodically repeated words by naming of power-of-two blocks.

Within each text every block of 2^k words gets a number, the same for equal blocks: a block's number comes from those of its
halves, and a block whose half stands nowhere else in the text can't be repeated and is not numbered again. How far two
places agree is read off the levels in descending order, without hashes and without sorted suffixes.

A run of period q repeats its words over at least 2 q of them, so for 2^k <= q < 2^(k+1) it has a whole aligned block of 2^k words
that stands again q words later. These pairs are all compared level by level as rows of a grid; the first of each stretch of
pairs is extended both ways to the whole run.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from inuring.llm.text import NON_SPACE, Texts, Words, add_columns, fresh, list_array

#: A run has at least so many words, and so many times its period.
LEAST_WORDS, LEAST_PERIODS = 24, 3
#: Blocks of 8 words find the periods below 8: such a run repeats at least 24 - 7 = 17 words, and so a whole aligned block.
BASE = 3


def _numbered(keys: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """For n places: below n and equal where the keys of the places ``at`` are equal, a value of its own everywhere else."""
    out = np.arange(n, 2 * n, dtype=np.int64 if n > 1 << 30 else np.int32)
    _, own, times = np.unique(keys, return_inverse=True, return_counts=True)
    again = times > 1
    number = np.cumsum(again) - 1
    held = again[own]
    out[at[held]] = number[own[held]]
    return out


def block_names(words: np.ndarray, doc: np.ndarray) -> list[np.ndarray]:
    """For each level k the number of the block of 2^k words at every place: below n if it stands again in the same text."""
    n = len(words)
    levels = [_numbered(doc.astype(np.int64) * (int(words.max(initial=0)) + 1) + words, np.arange(n), n)]
    while True:
        low, step = levels[-1], 1 << (len(levels) - 1)
        # a block across two texts differs from all others in the place where the text changes
        at = np.flatnonzero((low[:-step] < n) & (low[step:] < n)) if n > step else np.zeros(0, np.int64)
        if not len(at):
            return levels
        level = _numbered(low[at].astype(np.int64) * n + low[at + step], at, n)
        if not (level < n).any():
            return levels
        levels.append(level)


def agreement(levels: list[np.ndarray], x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many words from places x and y on are equal, and how many before them; x < y."""
    n = len(levels[0])
    ahead, back = np.zeros(len(x), np.int64), np.zeros(len(x), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        level, size = levels[k], 1 << k
        ends = y + ahead + size <= n
        ahead += size * (ends & (level[np.minimum(x + ahead, n - 1)] == level[np.minimum(y + ahead, n - 1)]))
        begins = x - back - size >= 0
        back += size * (begins & (level[np.maximum(x - back - size, 0)] == level[np.maximum(y - back - size, 0)]))
    return ahead, back


def grid_pairs(levels: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(place, period) of aligned blocks that stand again a period later; of neighbouring ones of a period the first."""
    n = len(levels[0])
    places, periods = [], []
    for k in range(BASE, len(levels)):
        size = 1 << k
        rows = levels[k][: n // size * size].reshape(-1, size)
        heads = np.flatnonzero(rows[:-1, 0] < n)
        if not len(heads):
            continue
        follows = np.zeros(len(heads), bool)
        follows[1:] = heads[1:] == heads[:-1] + 1
        found = [rows[heads + 1] == rows[heads, :1]]  # periods of size to 2 * size - 1
        first = size
        if k == BASE:
            first = 1
            found.insert(0, rows[heads, 1:] == rows[heads, :1])
        equal = np.concatenate(found, axis=1)
        new = equal.copy()
        new[1:] &= ~(equal[:-1] & follows[1:, None])
        row, column = np.nonzero(new)
        places.append(heads[row] * size)
        periods.append(column + first)
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *places]), np.concatenate([none, *periods])


def runs(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all runs of a chunk, by start and period; starts count the chunk's words."""
    none = np.zeros(0, np.int64)
    if not len(words):
        return none, none, none
    number, _ = words.encoded()
    levels = block_names(number, words.doc)
    place, period = grid_pairs(levels)
    ahead, back = agreement(levels, place, place + period)
    start, length = place - back, back + ahead + period
    long_enough = length >= np.maximum(LEAST_WORDS, LEAST_PERIODS * period)
    start, length, period = start[long_enough], length[long_enough], period[long_enough]
    # multiples of a run's period give the same stretch: the smallest is its period
    order = np.lexsort([period, length, start])
    start, length, period = start[order], length[order], period[order]
    new = np.ones(len(start), bool)
    new[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    start, length, period = start[new], length[new], period[new]
    order = np.lexsort([period, start])
    return start[order], length[order], period[order]


def joined(texts: Texts, words: Words, kept: np.ndarray) -> pa.Array:
    """The kept words of each text, joined by one space."""
    start, end, doc = words.starts[kept], words.ends[kept], words.doc[kept]
    size = end - start
    size[:-1] += doc[1:] == doc[:-1]  # a space after each word but a text's last
    to = np.cumsum(size)
    at = np.arange(to[-1] if len(to) else 0) - np.repeat(to - size - start, size)
    out = texts.data[np.minimum(at, max(len(texts.data) - 1, 0))]
    spaced = np.flatnonzero(size > end - start)
    out[to[spaced] - 1] = 0x20
    bounds = np.zeros(len(texts) + 1, np.int64)
    bounds[1:] = np.cumsum(np.bincount(doc, weights=size, minlength=len(texts)).astype(np.int64))
    wide = bounds[-1] >= 1 << 31
    kind, width = (pa.large_string(), np.int64) if wide else (pa.string(), np.int32)
    return pa.Array.from_buffers(kind, len(texts), [None, pa.py_buffer(bounds.astype(width)), pa.py_buffer(out)])


RUN = T.StructType([T.StructField("start", T.LongType()), T.StructField("length", T.LongType()), T.StructField("period", T.LongType())])


def collapse_runs(df: DataFrame, text: str = "text", keep_text: bool = True) -> DataFrame:
    """``df`` (without its text, unless ``keep_text``) with ``runs``, an array of (start, length, period) in words from 0, by start
    and period, and ``collapsed``: the words that no run contains after its first period, joined by one space.

    Words are what stands between spaces and tabs to carriage returns. A run is a stretch of words of which those a period
    apart are equal, the period the smallest such, at least LEAST_WORDS and LEAST_PERIODS periods long, that can't be made
    longer. A null or empty text has no runs and collapses to an empty string; repeated rows get equal results; an empty
    table stays empty. Names that ``df`` has get underscores. No shuffle; memory is bounded by a chunk or one text.
    """
    found, collapsed = fresh(df, "runs", "collapsed")

    def compute(texts: Texts, _) -> list:
        words = texts.words(NON_SPACE)
        start, length, period = runs(words)
        drop = np.zeros(len(words) + 1, np.int64)
        np.add.at(drop, start + period, 1)
        np.add.at(drop, start + length, -1)
        own = words.doc[start] if len(start) else np.zeros(0, np.int64)
        values = pa.StructArray.from_arrays([pa.array(x.astype(np.int64)) for x in (start - words.first[own], length, period)], names=["start", "length", "period"])
        return [list_array(np.bincount(own, minlength=len(texts)), values), joined(texts, words, np.cumsum(drop[:-1]) == 0)]

    fields = [T.StructField(found, T.ArrayType(RUN)), T.StructField(collapsed, T.StringType())]
    return add_columns(df, text, fields, compute, drop=() if keep_text else (text,))
