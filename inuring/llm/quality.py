"""Quality rules as a short-circuit cascade.

Each rule's cost and share of rejections are estimated on a bounded sample: the rule with the most rejections per second
comes first, the others are then estimated again on the texts that it leaves and with the measures that it has made, and so
on. A text that one rule rejects is not shown to the rules after it. A text is kept if no rule rejects it, so the order
changes the work and not the verdict.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inuring.llm.text import NON_SPACE, Texts, add_columns, byte_table, chunks, fresh

SYMBOLS = byte_table([(ord(c), ord(c)) for c in "#*$%&|<>"])
UPPER = byte_table([(ord("A"), ord("Z"))])
LETTER = byte_table([(ord("A"), ord("Z")), (ord("a"), ord("z")), (0x80, 0xFF)])
#: Texts that the costs and rejections of the rules are estimated on, and their bytes, but for one longer text.
SAMPLE_ROWS, SAMPLE_BYTES = 1000, 32 << 20


class Features:
    """Measures of a chunk's texts, each made when first asked for."""

    def __init__(self, texts: Texts, rows: np.ndarray | None = None):
        self._from, self._rows, self._made = texts, rows, {}

    def __len__(self) -> int:
        return len(self._from) if self._rows is None else len(self._rows)

    def __getattr__(self, name: str) -> np.ndarray:
        if name not in self._made:
            self._made[name] = getattr(type(self), f"_{name}")(self)
        return self._made[name]

    def take(self, rows: np.ndarray) -> Features:
        """The same for some of the texts; what is per text and made already is kept, bytes are copied only on demand."""
        out = Features(self._from, rows if self._rows is None else self._rows[rows])
        out._made = {k: v[rows] for k, v in self._made.items() if k not in ("texts", "words")}
        return out

    def again(self) -> Features:
        """The same texts with the measures made so far; what is made from now on stays apart."""
        out = Features(self._from, self._rows)
        out._made = dict(self._made)
        return out

    def _texts(self):
        return self._from if self._rows is None else self._from.take(self._rows)

    def _words(self):
        return self.texts.words(NON_SPACE)

    def _n_words(self):
        return self.words.counts

    def _word_chars(self):
        """Code points: the bytes in words but for the continuation bytes, which are never white space."""
        sizes = np.concatenate([[0], np.cumsum(self.words.ends - self.words.starts)])
        return np.diff(sizes[self.words.first]) - self.texts.per_text(np.flatnonzero((self.texts.data & 0xC0) == 0x80))

    def _n_symbols(self):
        return self.texts.per_text(np.flatnonzero(SYMBOLS[self.texts.data]))

    def _n_upper(self):
        return self.texts.per_text(np.flatnonzero(UPPER[self.texts.data]))

    def _n_letters(self):
        return self.texts.per_text(np.flatnonzero(LETTER[self.texts.data] & ((self.texts.data & 0xC0) != 0x80)))

    def _lines(self):
        """Lines with a word, and how many of them equal an earlier one."""
        out = np.zeros((len(self.texts), 2), np.int64)
        for i in range(len(self.texts)):
            lines = [x for x in self.texts.bytes(i).split(b"\n") if x and not x.isspace()]
            out[i] = len(lines), len(lines) - len(set(lines))
        return out

    def _n_lines(self):
        return self.lines[:, 0]

    def _n_dup_lines(self):
        return self.lines[:, 1]

    def _n_repeat_words(self):
        """Words inside a window of three that the text has at least twice."""
        words = self.words
        if len(words) < 3:
            return np.zeros(len(self), np.int64)
        number, distinct = words.encoded()
        number = number.astype(np.int64)
        at = np.flatnonzero(words.within(3))
        # numbers of pairs and words stay below the words of a chunk, so the keys stay below 2**63
        pair = pa.array(number[at] * len(distinct) + number[at + 1]).dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
        own = pa.array((pair * len(distinct) + number[at + 2]) * len(self) + words.doc[at]).dictionary_encode().indices.to_numpy(zero_copy_only=False)
        again = at[np.bincount(own)[own] >= 2]
        hit = np.zeros(len(words), bool)
        for k in range(3):
            hit[again + k] = True
        return np.diff(np.concatenate([[0], np.cumsum(hit)])[words.first])


@dataclass(frozen=True)
class Rule:
    """``rejects`` gives True for each text that the rule turns down."""

    name: str
    rejects: Callable[[Features], np.ndarray]


#: A text has to pass all of these. Ratios are compared without division, so a text without words or lines is safe.
RULES = (
    Rule("few_words", lambda f: f.n_words < 50),
    Rule("repeated_words", lambda f: 100 * f.n_repeat_words > 50 * f.n_words),
    Rule("symbols", lambda f: 10 * f.n_symbols > 3 * f.n_words),
    Rule("repeated_lines", lambda f: 2 * f.n_dup_lines > f.n_lines),
    Rule("word_length", lambda f: (f.word_chars < 2 * f.n_words) | (f.word_chars > 20 * f.n_words)),
    Rule("upper_case", lambda f: 2 * f.n_upper > f.n_letters),
)
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def cascade(features: Features, rules: tuple[Rule, ...]) -> np.ndarray:
    """True for the texts that no rule rejects; rules see only what those before left, once that is well under what is at hand."""
    kept, rows, live = np.ones(len(features), bool), np.arange(len(features)), np.ones(len(features), bool)
    for rule in rules:
        bad = np.asarray(rule.rejects(features), bool)
        kept[rows[bad]] = False
        live &= ~bad
        if not live.any():
            break
        if 4 * np.count_nonzero(live) < 3 * len(live):
            rows, features = rows[live], features.take(np.flatnonzero(live))
            live = np.ones(len(rows), bool)
    return kept


def greedy_order(parts: list[Features], rules: tuple[Rule, ...]) -> list[tuple[str, float, float]]:
    """(name, seconds a text, share rejected), each on the texts that the rules before it leave and beside their measures."""
    out, rest = [], list(rules)
    while rest:
        found = []
        for rule in rest:
            began = time.perf_counter()
            bad = [np.asarray(rule.rejects(part.again()), bool) for part in parts]
            seconds, n = time.perf_counter() - began, sum(map(len, parts))
            found.append((sum(map(np.count_nonzero, bad)) / max(seconds, 1e-9), -len(found), seconds / max(n, 1), sum(map(np.count_nonzero, bad)) / max(n, 1), rule))
        _, _, seconds, share, best = max(found, key=lambda x: x[:2])
        out.append((best.name, seconds, share))
        rest.remove(best)
        parts = [part.take(np.flatnonzero(~np.asarray(best.rejects(part), bool))) for part in parts]
    return out


def rule_order(df: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES, sample_rows: int = SAMPLE_ROWS) -> list[tuple[str, float, float]]:
    """(name, seconds a text, share rejected) in the order to run, from at most ``sample_rows`` texts of SAMPLE_BYTES in all.

    Without rows the rules keep their order.
    """
    n = df.count()
    sample = df.select(text) if n <= sample_rows else df.select(text).sample(fraction=min(1.0, 1.3 * sample_rows / n), seed=8).limit(sample_rows)

    def timed(batches):
        held, room = [], SAMPLE_BYTES
        for batch in batches:
            for _, texts in chunks(batch, text):
                if not held or len(texts.data) <= room:
                    held.append(Features(texts))
                    room -= len(texts.data)
        found = greedy_order(held, rules) if held else []
        yield pa.RecordBatch.from_pydict({"place": pa.array(range(len(found)), pa.int64()), "rule": pa.array([x[0] for x in found], pa.string()), "s": pa.array([x[1] for x in found], pa.float64()), "bad": pa.array([x[2] for x in found], pa.float64())})

    rows = sample.repartition(1).mapInArrow(timed, "place long, rule string, s double, bad double").collect()  # a row for each rule
    return [(r.rule, r.s, r.bad) for r in sorted(rows, key=lambda r: r.place)] or [(rule.name, 0.0, 0.0) for rule in rules]


def ordered(df: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES, sample_rows: int = SAMPLE_ROWS) -> tuple[Rule, ...]:
    """The rules by rejections per cost on a sample of ``df``."""
    by_name = {rule.name: rule for rule in rules}
    return tuple(by_name[name] for name, _, _ in rule_order(df, text, rules, sample_rows))


def quality_filter(df: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The rows whose text passes all rules, with their columns as they were.

    Null and empty texts have no words and are rejected by ``few_words``; equal rows get equal verdicts; an empty table
    stays empty. Nothing is shuffled but the sample.
    """
    rules = ordered(df, text, rules, sample_rows)
    (name,) = fresh(df, "kept")
    out = add_columns(df, text, [T.StructField(name, T.BooleanType())], lambda texts, _: [cascade(Features(texts), rules)], keep=lambda made: made[0].to_numpy(zero_copy_only=False))
    return out.drop(name)


def quality_report(df: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES, sample_rows: int = SAMPLE_ROWS, keep_text: bool = True) -> DataFrame:
    """All rows of ``df`` (without their text, unless ``keep_text``) with the cascade's verdict ``kept`` and the measures of the whole text, rejected or not.

    Names that ``df`` has already get underscores. Null and empty texts have zeros and are not kept.
    """
    rules = ordered(df, text, rules, sample_rows)
    names = fresh(df, *MEASURES, "kept")

    def measured(texts: Texts, _) -> list:
        features = Features(texts)
        kept = cascade(features, rules)  # first: what its rules measure of all texts is at hand then
        return [*(getattr(features, k).astype(np.int64) for k in MEASURES), kept]

    return add_columns(df, text, [T.StructField(n, T.LongType()) for n in names[:-1]] + [T.StructField(names[-1], T.BooleanType())], measured, drop=() if keep_text else (text,))
