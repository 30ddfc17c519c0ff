"""Benchmark decontamination by suffix arrays of the training texts.

The training table is cut into shards (chunks of bounded size inside the tasks). Each shard gets a suffix array over its
words, every distinct window of the benchmark is binary-searched in it, and the range found gives all places of the match;
places that continue each other are one longest verbatim match. The benchmark goes to the tasks in blocks of bounded size,
which a task's one worker searches one after another.

A window that stands many times, in one item or in many, is searched once; a place of a text then belongs to the items of its
window, so the work grows with places and not with pairs of places.

A shard word that no item of the block has can't be part of a match, so it ends the training string before it, and so does the
last word of three that no item has in a row; suffixes shorter than the shortest window are left out of the array. Windows with
three words in a row that the shard lacks are not searched. Both are told by hashed marks of each side's triples: a mark set by
another triple only leaves something in.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inuring.llm.text import WORD, Texts, Words, add_columns, fresh, list_array, texts_of

#: Words of an item that have to stand together in a document; a shorter item counts as one window.
WINDOW = 10
#: Bytes of benchmark text that are sent to the tasks at a time.
BLOCK_BYTES = 8 << 20
#: Blocks up to which a worker keeps them all at hand; of more it holds one at a time.
HELD_BLOCKS = 4
#: Marks a triple of words at least, so that few are set by chance.
MARKS_EACH = 16


def triples(words: np.ndarray) -> np.ndarray:
    """A hash of each word with the two after it; fewer at the end."""
    rest = np.concatenate([words, [0, 0]]).astype(np.uint64)
    mixed = rest[:-2] * np.uint64(0x9E3779B97F4A7C15) + rest[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F) + rest[2:] * np.uint64(0x165667B19E3779F9)
    mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (mixed >> np.uint64(32)).astype(np.uint32)


def marked(hashes: np.ndarray) -> np.ndarray:
    """Marks as bits, a power of two of them, of which those of the hashes are set."""
    marks = np.zeros(1 << (max(len(hashes), 1) * MARKS_EACH - 1).bit_length(), bool)
    marks[hashes & np.uint32(len(marks) - 1)] = True
    return np.packbits(marks, bitorder="little")


def has(marks: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """False for hashes that are not among the marked ones."""
    at = hashes & np.uint32(8 * len(marks) - 1)
    return (marks[at >> np.uint32(3)] >> (at & np.uint32(7)).astype(np.uint8) & 1).astype(bool)


@dataclass
class Block:
    """Benchmark items as numbered words, 0 after each item, and their distinct windows: ``place`` is where a window stands
    first, ``need`` its length. The items of window w are ``item[first[w] : first[w + 1]]``, and ``at`` its position in each,
    -1 where it stands several times. ``triple`` and ``marks`` are its triples of words, one at each of ``words``."""

    vocabulary: pa.Array
    words: np.ndarray
    place: np.ndarray
    need: np.ndarray
    first: np.ndarray
    item: np.ndarray
    at: np.ndarray
    names: list[str]
    triple: np.ndarray
    marks: np.ndarray

    @staticmethod
    def of(names: list[str], texts: Texts, window: int) -> Block:
        words = texts.words(WORD, lower=True)
        number, vocabulary = words.encoded()
        shape = words.counts + 1  # an end after each item
        ends = np.cumsum(shape)
        flat = np.zeros(ends[-1] if len(ends) else 0, np.int32)
        position = np.arange(len(flat)) - np.repeat(ends - shape, shape)
        item = np.repeat(np.arange(len(names)), shape)
        length = np.minimum(words.counts, window)[item]
        flat[position < words.counts[item]] = number + 1
        triple = triples(flat)
        place = np.flatnonzero((length > 0) & (position + length <= words.counts[item]))
        length = length[place]
        rows = np.zeros((len(place), window), np.int32)
        for k in range(window):
            inside = k < length
            rows[inside, k] = flat[place[inside] + k]
        _, some, own = np.unique(rows, axis=0, return_index=True, return_inverse=True)
        own = own.ravel()
        order = np.lexsort([position[place], item[place], own])
        own, own_item, own_at = own[order], item[place][order], position[place][order]
        new = np.ones(len(own), bool)
        new[1:] = (own[1:] != own[:-1]) | (own_item[1:] != own_item[:-1])
        start = np.flatnonzero(new)
        times = np.diff(np.append(start, len(own)))
        first = np.searchsorted(own[start], np.arange(len(some) + 1))
        return Block(vocabulary, flat, place[some].astype(np.int32), length[some].astype(np.int32), first, own_item[start].astype(np.int32), np.where(times == 1, own_at[start], -1).astype(np.int32), names, triple, marked(triple))


def suffix_array(words: np.ndarray, runs: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The places ``at`` in the order of the words from there on; ``runs`` is how many words the string has from each place.

    Ranks by one word, then two, four and so on, until all are apart or no string is longer.
    """
    rank, step = words.astype(np.int64), 1
    n = len(words)
    while True:
        nxt = np.zeros(n, np.int64)
        nxt[: n - step] = rank[step:]
        nxt[runs <= step] = 0
        key = rank * (int(rank.max(initial=0)) + 1) + nxt
        distinct, rank = np.unique(key, return_inverse=True)
        rank = rank.ravel().astype(np.int64) + 1
        step *= 2
        if step >= runs.max(initial=0) or len(distinct) == n:
            break
    return at[np.argsort(rank[at], kind="stable")]


def _bounds(words: np.ndarray, runs: np.ndarray, array: np.ndarray, block: Block, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each of the benchmark's windows the range of the array whose strings begin with it: two binary searches."""
    need, suffixes = block.need[windows], block.place[windows].astype(np.int64)
    found = []
    for upper in (False, True):
        low, high = np.zeros(len(suffixes), np.int64), np.full(len(suffixes), len(array), np.int64)
        while (open_ := low < high).any():
            mid = (low + high) // 2
            place = array[np.minimum(mid, len(array) - 1)]
            order = np.zeros(len(suffixes), np.int8)  # of the array's string against the window
            for k in range(int(need.max(initial=0))):
                ask = (order == 0) & (k < need)
                if not ask.any():
                    break
                have = np.where(k < runs[place], words[np.minimum(place + k, len(words) - 1)], 0)
                want = block.words[np.minimum(suffixes + k, len(block.words) - 1)]
                order = np.where(ask, np.sign(have - want), order).astype(np.int8)
            right = (order < 0) | (upper & (order == 0))
            low, high = np.where(open_ & right, mid + 1, low), np.where(open_ & ~right, mid, high)
        found.append(low)
    return found[0], found[1]


def matches(words: Words, block: Block) -> np.ndarray:
    """Rows (text, item, start, length) of the longest verbatim matches, at least a window long, by text, item and start.

    Windows at neighbouring places are one match if they may stand at neighbouring positions of the item; where an item
    repeats a window, they always may.
    """
    none = np.zeros((0, 4), np.int64)
    if not len(words) or not len(block.place):
        return none
    number = pc.fill_null(pc.index_in(words.array(), value_set=block.vocabulary), -1).to_numpy(zero_copy_only=False).astype(np.int64) + 1
    ends = np.flatnonzero(number == 0)
    stop = np.concatenate([ends, words.first[1:]])  # a string ends at an unknown word or with its text
    stop = np.unique(stop)
    runs = stop[np.searchsorted(stop, np.arange(len(number)), side="right")] - np.arange(len(number)) if len(stop) else np.zeros(0, np.int64)
    runs[number == 0] = 0
    # what a place shares with the block ends before the third word of a triple that the block lacks
    own = triples(number)
    lacks = np.append(np.flatnonzero(~has(block.marks, own)), len(number))
    shared = np.minimum(runs, lacks[np.searchsorted(lacks, np.arange(len(number)))] + 2 - np.arange(len(number)))
    least = int(block.need.min())
    keep = np.flatnonzero(shared >= least)
    if not len(keep):
        return none
    # only the strings that hold a long enough suffix go into the array
    inside = np.zeros(len(number) + 1, np.int64)
    np.add.at(inside, keep, 1)
    np.add.at(inside, keep + least, -1)
    used = np.flatnonzero(np.cumsum(inside[:-1]) > 0)
    missing = np.concatenate([[0], np.cumsum(~has(marked(own[used]), block.triple))])
    windows = np.flatnonzero(missing[block.place + np.maximum(block.need - 2, 0)] == missing[block.place])
    # a string goes on as far as the words left in do, also beyond what it shares, so its end is that of its own suffixes; it needs
    # no order beyond the longest window
    last = np.append(np.flatnonzero(np.diff(used) > 1), len(used) - 1)
    small, left = number[used], last[np.searchsorted(last, np.arange(len(used)))] + 1 - np.arange(len(used))
    short = np.minimum(np.minimum(runs[used], left), int(block.need.max()))
    array = suffix_array(small, short, np.searchsorted(used, keep))
    low, high = _bounds(small, short, array, block, windows)
    many = high - low
    if not many.any():
        return none
    which = np.repeat(windows, many)
    place = used[array[np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(low, many)]]
    items = np.diff(block.first)[which]
    entry = np.arange(items.sum()) - np.repeat(np.cumsum(items) - items, items) + np.repeat(block.first[which], items)
    place, need = np.repeat(place, items), np.repeat(block.need[which], items).astype(np.int64)
    doc = words.doc[place]
    item, start, at = block.item[entry].astype(np.int64), place - words.first[doc], block.at[entry]
    order = np.lexsort([start, item, doc])
    doc, item, start, need, at = doc[order], item[order], start[order], need[order], at[order]
    new = np.ones(len(doc), bool)
    apart = (at[1:] >= 0) & (at[:-1] >= 0) & (at[1:] != at[:-1] + 1)
    new[1:] = (doc[1:] != doc[:-1]) | (item[1:] != item[:-1]) | (start[1:] != start[:-1] + 1) | apart
    first = np.flatnonzero(new)
    last = np.concatenate([first[1:], [len(doc)]]) - 1
    return np.column_stack([doc[first], item[first], start[first], start[last] + need[last] - start[first]])


def benchmark_parts(benchmark: DataFrame, item_id: str, text: str, block_bytes: int) -> list[DataFrame]:
    """The items in as many parts as keep each near ``block_bytes``, dealt by a hash of the text."""
    items = benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    size = items.agg(F.coalesce(F.sum(F.octet_length("text") + F.octet_length("item")), F.lit(0)).alias("n")).first()["n"]
    n = -(-size // block_bytes)
    if n <= 1:
        return [items]
    return [items.where(F.pmod(F.xxhash64("text", "item"), F.lit(n)) == k) for k in range(n)]


def find_matches(df: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES, keep_text: bool = True) -> DataFrame:
    """``df`` (without its text, unless ``keep_text``) with ``n_words`` and ``matches``: an array of (item, start, length), the longest verbatim matches of at least
    ``window`` words with a benchmark item, in words of the document from 0.

    Words are runs of digits, a-z and characters beyond ASCII, after A-Z are lower-cased. An item with fewer words than a
    window matches as a whole; one without words never does. Items are named by their id as a string, a null id by the
    empty string; items of one name count as one. Null and empty documents have no words and no matches, repeated rows
    get equal results, empty tables on either side give no matches. Names that ``df`` has get underscores. No shuffle.
    """
    spark = df.sparkSession
    n_words, found = fresh(df, "n_words", "matches")
    match = T.StructType([T.StructField("item", T.StringType()), T.StructField("start", T.LongType()), T.StructField("length", T.LongType())])
    sent = []
    for part in benchmark_parts(benchmark, item_id, item_text, block_bytes):
        rows = part.collect()  # near block_bytes
        sent.append(spark.sparkContext.broadcast(Block.of([r.item for r in rows], texts_of(pa.array([r.text for r in rows], pa.string())), window)))

    def search(texts: Texts, _) -> list:
        words = texts.words(WORD, lower=True)
        hits, names = [np.zeros((0, 4), np.int64)], [pa.array([], pa.string())]
        for block in sent:
            hits.append(matches(words, block.value))
            names.append(pa.array(block.value.names, pa.string()).take(pa.array(hits[-1][:, 1])))
            if len(sent) > HELD_BLOCKS:
                vars(block).pop("_value", None)  # read from the executor's disk again for the next chunk
        every, named = np.concatenate(hits), pa.concat_arrays(names)
        order = np.argsort(every[:, 0], kind="stable")
        values = pa.StructArray.from_arrays([named.take(pa.array(order)), pa.array(every[order, 2]), pa.array(every[order, 3])], names=["item", "start", "length"])
        return [pa.array(words.counts.astype(np.int64)), list_array(np.bincount(every[:, 0], minlength=len(texts)), values)]

    return add_columns(df, text, [T.StructField(n_words, T.LongType()), T.StructField(found, T.ArrayType(match))], search, drop=() if keep_text else (text,))


def words_hit(found: Column) -> Column:
    """Words inside any of the matches, each counted once."""
    spans = F.array_sort(F.transform(found, lambda m: F.struct(m["start"].alias("a"), (m["start"] + m["length"]).alias("b"))))
    nothing = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("to"))
    return F.aggregate(spans, nothing, lambda s, x: F.struct((s["n"] + F.greatest(x["b"] - F.greatest(x["a"], s["to"]), F.lit(0))).alias("n"), F.greatest(s["to"], x["b"]).alias("to")))["n"]


def items_hit(found: Column) -> Column:
    """Names of the items with a match, each once, sorted as strings."""
    return F.array_sort(F.array_distinct(F.transform(found, lambda m: m["item"])))


def decontaminate(df: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``df`` without any match, with their columns as they were; edge cases as in ``find_matches``."""
    n_words, found = fresh(df, "n_words", "matches")
    out = find_matches(df, benchmark, text, item_id, item_text, window, block_bytes)
    return out.where(F.size(found) == 0).drop(n_words, found)
