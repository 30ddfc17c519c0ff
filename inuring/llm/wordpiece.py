"""Token counts by a linear longest-match automaton.

The vocabulary's pieces form a trie: those that begin a word below one root, those that continue it below another. Greedy
longest-match splitting is then a walk: where the trie has no edge for the next byte, the piece matched last is popped and
the walk goes on at the failure link's node, with the bytes read since. The number of pieces that a failure pops is
precomputed, so a word's token count needs one pass over its bytes and no pieces.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from inuring.llm.text import NON_SPACE, Texts, add_columns, fresh

#: Node numbers of the two roots.
START, INNER = 0, 1
#: Words below which they don't go forward side by side any more.
FEW = 16


class Automaton:
    """Trie edges as a table of node * 256 + byte, failure links, and how many pieces following a link pops.

    ``link[v] == -1``: no split of what v spells begins with its longest match and goes on in the trie; the word can't be
    split then. ``end`` tells how many pieces the string of a node takes if the word ends there, -1 if it can't end there.
    """

    def __init__(self, initial: list[bytes], inner: list[bytes]):
        edges: list[dict[int, int]] = [{}, {}]
        pieces: list[bool] = [False, False]
        for root, words in ((START, initial), (INNER, inner)):
            for word in words:
                at = root
                for b in word:
                    if b not in edges[at]:
                        edges[at][b] = len(edges)
                        edges.append({})
                        pieces.append(False)
                    at = edges[at][b]
                pieces[at] |= bool(word)
        link, pops = [-1] * len(edges), [0] * len(edges)
        level = [START, INNER]
        while level:  # shorter strings first, from both roots
            below = []
            for u in level:
                for b, v in edges[u].items():
                    below.append(v)
                    if pieces[v]:
                        link[v], pops[v] = INNER, 1
                        continue
                    z, n = link[u], pops[u]
                    while z != -1 and b not in edges[z]:
                        z, n = link[z], n + pops[z]
                    if z != -1:
                        link[v], pops[v] = edges[z][b], n
            level = below
        self.size = len(edges)
        self.link, self.pops = np.array(link, np.int32), np.array(pops, np.int32)
        keys = np.array([u << 8 | b for u in range(len(edges)) for b in edges[u]], np.int64)
        to = np.array([v for u in range(len(edges)) for v in edges[u].values()], np.int32)
        # open addressing: one or two looks for each byte
        self.bits = max(4, int(len(keys) * 4).bit_length())
        self.slot_key, self.slot_to = self._slots(keys, to)
        self.end = np.array([self._ends_at(v) for v in range(len(edges))], np.int32)

    def _ends_at(self, v: int) -> int:
        n = 0
        while v not in (START, INNER):
            if v == -1 or self.link[v] == -1:
                return -1
            n, v = n + int(self.pops[v]), int(self.link[v])
        return n if v == INNER else -1

    def _place(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.bits)).astype(np.int64)

    def _slots(self, keys: np.ndarray, to: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        slots = np.full(1 << self.bits, -1, np.int64)
        todo, at = np.arange(len(keys)), self._place(keys)
        while len(todo):
            free = slots[at] < 0
            slots[at[free]] = todo[free]
            lost = slots[at] != todo
            todo, at = todo[lost], (at[lost] + 1) & ((1 << self.bits) - 1)
        used = np.flatnonzero(slots >= 0)
        slot_key, slot_to = np.full(len(slots), -1, np.int64), np.full(len(slots), -1, np.int32)
        slot_key[used], slot_to[used] = keys[slots[used]], to[slots[used]]
        return slot_key, slot_to

    def go(self, node: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """The child of each node by each byte, -1 where there is none."""
        key = node.astype(np.int64) << 8 | byte
        at = self._place(key)
        out, have = self.slot_to[at], self.slot_key[at]
        rows = np.flatnonzero((have != key) & (have >= 0))
        out[have != key] = -1
        while len(rows):
            at[rows] = (at[rows] + 1) & ((1 << self.bits) - 1)
            have = self.slot_key[at[rows]]
            hit = have == key[rows]
            out[rows[hit]] = self.slot_to[at[rows[hit]]]
            rows = rows[~hit & (have >= 0)]
        return out

    def _walk(self, node: int, n: int, data: bytes) -> tuple[int, int]:
        """The node and the pieces popped after one word's bytes, the same walk as in ``counts``."""
        if not hasattr(self, "_edges"):
            used = np.flatnonzero(self.slot_key >= 0)
            self._edges = dict(zip(self.slot_key[used].tolist(), self.slot_to[used].tolist()))
            self._links = self.link.tolist(), self.pops.tolist()
        edges, (link, pops) = self._edges, self._links
        for b in data:
            while node >= 0:
                to = edges.get(node << 8 | b)
                if to is not None:
                    node = to
                    break
                n, node = n + pops[node], link[node]
            if node < 0:
                break
        return node, n

    def counts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Pieces of each word, -1 if it can't be split. The words go forward side by side, the longest first, and the last FEW
        are finished one by one, so the work is linear in the bytes whatever the longest word."""
        lengths = np.diff(offsets)
        order = np.argsort(-lengths, kind="stable")
        start, left = offsets[:-1][order], lengths[order]
        node, n = np.zeros(len(order), np.int32), np.zeros(len(order), np.int64)
        done, shortest_last = 0, -left
        while True:
            live = int(np.searchsorted(shortest_last, -done, side="left"))
            if live < FEW:
                break
            rows = np.flatnonzero(node[:live] >= 0)
            byte = data[start[rows] + done]
            while len(rows):
                to = self.go(node[rows], byte)
                found = to >= 0
                node[rows[found]] = to[found]
                rows, byte = rows[~found], byte[~found]
                n[rows] += self.pops[node[rows]]
                node[rows] = self.link[node[rows]]
                open_ = node[rows] >= 0
                rows, byte = rows[open_], byte[open_]
            done += 1
        for i in range(live):
            node[i], n[i] = self._walk(int(node[i]), int(n[i]), data[start[i] + done : start[i] + left[i]].tobytes())
        last = np.where(node >= 0, self.end[np.maximum(node, 0)], -1)
        out = np.empty(len(order), np.int64)
        out[order] = np.where(last >= 0, n + last, -1)
        return out


def byte_pieces(vocabulary_file: str) -> tuple[list[bytes], list[bytes]]:
    """(pieces that begin a word, pieces that continue one) of a byte-level vocabulary file.

    Its tokens spell bytes by printable characters; one with the sign of a leading space begins a word. Every byte is a piece
    of both kinds, so each word can be split.
    """
    with open(vocabulary_file, encoding="utf-8") as f:
        tokens = json.load(f)["model"]["vocab"]
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spelled = {chr(b): b for b in printable} | {chr(0x100 + k): b for k, b in enumerate(b for b in range(256) if b not in printable)}
    every = [bytes([b]) for b in range(256)]
    raw = [bytes(spelled[c] for c in token) for token in tokens]
    initial = [w[1:] for w in raw if w[:1] == b" " and len(w) > 1]
    return every + initial, every + [w for w in raw if w[:1] != b" "]


def count_tokens(df: DataFrame, initial: list[bytes], inner: list[bytes], text: str = "text", keep_text: bool = True) -> DataFrame:
    """``df`` (without its text, unless ``keep_text``) with ``n_words``, ``n_tokens`` and ``n_unknown``: words are runs without white space, each is split greedily
    into the longest pieces (``initial`` first, then ``inner``), and a word that can't be split counts as one token.

    Null and empty texts have zeros, repeated rows equal counts, an empty table stays empty; words of any length are walked
    whole. Names that ``df`` has already get underscores. No shuffle; equal words of a chunk are walked once.
    """
    sent = df.sparkSession.sparkContext.broadcast(Automaton(initial, inner))  # as large as the vocabulary

    def count(texts: Texts, _) -> list:
        words = texts.words(NON_SPACE)
        number, distinct = words.encoded()
        offsets = np.frombuffer(distinct.buffers()[1], np.int32)[: len(distinct) + 1].astype(np.int64) if len(distinct) else np.zeros(1, np.int64)
        data = np.frombuffer(distinct.buffers()[2], np.uint8) if len(distinct) else np.zeros(0, np.uint8)
        each = sent.value.counts(data, offsets)[number]
        total = lambda x: np.diff(np.concatenate([[0], np.cumsum(x)])[words.first]).astype(np.int64)
        return [words.counts.astype(np.int64), total(np.where(each < 0, 1, each)), total(each < 0)]

    return add_columns(df, text, [T.StructField(n, T.LongType()) for n in fresh(df, "n_words", "n_tokens", "n_unknown")], count, drop=() if keep_text else (text,))
