"""Removal of long byte strings that stand in a corpus more than once, by run-length indexes.

A run-length index holds strings by their Burrows-Wheeler transform, compressed to runs of one symbol, with the suffixes at the
ends of each run and how far they agree with the suffix beyond it. Inside a run that agreement goes down by one with each
place of the text, so one pass over the text gives the matching statistics: how far the string from each place on stands
somewhere else too. Copies make the runs longer and not more.

What is equal has to be in one index. Every window of LENGTH bytes is sent to the index of its anchor, the ANCHOR-byte string in it
whose hash is smallest; equal windows have equal anchors. Neighbouring windows of one anchor travel as one piece, and only if
the anchor stands twice in the corpus, so unique text is never sent. Equal pieces are one string of the index with a number.
An anchor of more than CROWD distinct pieces is not sent to one task: its windows are dealt anew by the anchor and half of what
they still may differ in before or after it, and so on; after nine halvings the anchor is the window.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inuring.llm.scratch import intermediate, written
from inuring.llm.text import bound_batches, chunks, fresh, list_array, texts_of

#: Bytes of a string that counts as repeated, and of the anchors in it.
LENGTH, ANCHOR = 400, 128
#: Distinct pieces of one anchor that go to one index.
CROWD = 1024
#: Bytes of pieces in one index, but for the last anchor's.
INDEX_BYTES = 1 << 20
#: Bytes of text that a step works on.
STEP_BYTES = 1 << 20
#: Keys of more than one in HOT rows, HOT of them at most, are dealt to SPREAD tasks.
HOT, SPREAD = 1000, 64

_POSITION = (1 << 24) - 1


# --- anchors --------------------------------------------------------------------------------------------------------
def _hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the ANCHOR bytes from each place on: of one byte, then of two, four and so on."""
    rnd = np.random.Generator(np.random.PCG64(400))
    h = rnd.integers(0, 1 << 64, 256, np.uint64)[data]
    factors = rnd.integers(0, 1 << 63, 32, np.uint64) * np.uint64(2) + np.uint64(1)
    size = 1
    while size < ANCHOR:
        h = h[:-size] * factors[size.bit_length()] + h[size:]
        size *= 2
    h ^= h >> np.uint64(31)
    h *= factors[0]
    h ^= h >> np.uint64(29)
    return h


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of the ``width`` values from each place on."""
    size = 1
    while 2 * size <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    return np.minimum(values[: len(values) - (width - size)], values[width - size :]) if width > size else values


def anchors(data: np.ndarray, bounds: np.ndarray, length: int, step: int = STEP_BYTES) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For all windows inside texts, a section after the other: place, text, hash of the anchor and place of the anchor."""
    for begin in range(0, max(len(data) - length + 1, 0), step):
        part = data[begin : begin + step + length - 1]
        h = _hashes(part)
        # of equal hashes the last
        packed = (h & ~np.uint64(_POSITION)) | (np.uint64(_POSITION) - np.arange(len(h), dtype=np.uint64))
        at = _POSITION - (_least(packed, length - ANCHOR + 1) & np.uint64(_POSITION)).astype(np.int64)
        place = np.arange(len(at)) + begin
        text = np.searchsorted(bounds, place, side="right") - 1
        inside = place + length <= bounds[text + 1]
        yield place[inside], text[inside], h[at[inside]].view(np.int64), at[inside] + begin


def _runs(*keys: np.ndarray) -> np.ndarray:
    """Where a key differs from the one before."""
    new = np.ones(len(keys[0]), bool)
    new[1:] = False
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return new


def _anchor_rows(length: int, step: int) -> Callable:
    """(id, text) to (id, value, start, windows, places): neighbouring windows of one anchor value, and how many places of that
    value they have."""
    most = length - ANCHOR + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in chunks(batch, "text", STEP_BYTES):
                ids = part.column("id").to_numpy(zero_copy_only=False)
                for place, text, value, at in anchors(texts.data, texts.bounds, length, step):
                    if not len(place):
                        continue
                    new = _runs(text, value)
                    # long stretches of one value, in periodic text, are cut
                    since = np.arange(len(place)) - np.maximum.accumulate(np.where(new, np.arange(len(place)), 0))
                    first = np.flatnonzero(new | (since % most == 0))
                    moved = np.concatenate([[0], np.cumsum(_runs(text, at))])
                    last = np.append(first[1:], len(place))
                    places = moved[last] - moved[first + 1] + 1
                    columns = [ids[text[first]], value[first], (place[first] - texts.bounds[text[first]]), last - first, places]
                    yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in columns], names=["id", "value", "start", "windows", "places"])

    return run


# --- pieces ---------------------------------------------------------------------------------------------------------
def _slices(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Slices of the bytes as an Arrow array, their bytes one after the other, and where each begins."""
    to = np.concatenate([[0], np.cumsum(size)])
    at = np.arange(to[-1]) + np.repeat(start - to[:-1], size)
    out = data[at]
    return pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(to.astype(np.int32)), pa.py_buffer(out)]), out, to


def _digests(out: np.ndarray, start: np.ndarray, end: np.ndarray, size: int) -> list[bytes]:
    view = memoryview(out)
    return [hashlib.blake2b(view[a:b], digest_size=size).digest() for a, b in zip(start.tolist(), end.tolist())]


PIECES = "value long, id long, start long, n long, digest binary, piece binary, core int, size int"
_NAMES = [x.split()[0] for x in PIECES.split(", ")]


def _piece_batch(value, ids, start, n, data, at, size, core, core_size) -> pa.RecordBatch:
    pieces, out, to = _slices(data, at, size)
    if value is None:  # of the core
        value = np.frombuffer(b"".join(_digests(out, to[:-1] + core, to[:-1] + core + core_size, 8)), np.int64)
    digest = pa.array(_digests(out, to[:-1], to[1:], 16), pa.binary())
    longs = [pa.array(np.asarray(x, np.int64)) for x in (value, ids, start, n)]
    return pa.RecordBatch.from_arrays([*longs, digest, pieces, pa.array(core.astype(np.int32)), pa.array(core_size.astype(np.int32))], names=_NAMES)


def _cut(length: int) -> Callable:
    """(id, text, n, found) to pieces; ``found`` lists (value, start, windows)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in chunks(batch, "text", STEP_BYTES):
                found = part.column("found")
                many = np.diff(found.offsets.to_numpy())
                value, start, windows = (x.to_numpy(zero_copy_only=False) for x in found.flatten().flatten())
                ids, n = (np.repeat(part.column(c).to_numpy(zero_copy_only=False), many) for c in ("id", "n"))
                at = np.repeat(texts.bounds[:-1], many) + start
                for a in range(0, len(at), 8192):
                    s = slice(a, a + 8192)
                    none = np.full(len(at[s]), -1)
                    yield _piece_batch(value[s], ids[s], start[s], n[s], texts.data, at[s], windows[s] + length - 1, none, none)

    return run


def _split(length: int) -> Callable:
    """Pieces of crowded anchors to pieces whose core, which all their windows hold, is longer by half of the rest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in chunks(batch, "piece", STEP_BYTES):
                ids, start, n, core, size = (part.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("id", "start", "n", "core", "size"))
                if len(core) and core[0] < 0:  # the pieces of one call have all been halved equally often
                    found = [x for x in anchors(texts.data, texts.bounds, length) if len(x[0])]
                    place, text, _, at = (np.concatenate([x[k] for x in found]) for k in range(4))
                    first = np.flatnonzero(_runs(text, at))
                    last = np.append(first[1:], len(place)) - 1
                    text, low, high, at = text[first], place[first], place[last], at[first]
                    size = np.full(len(at), ANCHOR)
                else:
                    text = np.arange(len(texts))
                    low, high, at = texts.bounds[:-1], texts.bounds[1:] - length, texts.bounds[:-1] + core
                half = (length - size + 1) // 2
                cut = np.minimum(high, at - half)  # up to here a window has half of the rest before the core
                sides = [(low, cut, at - half), (np.maximum(low, cut + 1), high, at)]
                for a, b, core_at in sides:
                    has = a <= b
                    if has.any():
                        a, b, core_at, own, more = a[has], b[has], core_at[has], text[has], (size + half)[has]
                        yield _piece_batch(None, ids[own], start[own] + a - texts.bounds[own], n[own], texts.data, a, b - a + length, core_at - a, more)

    return run


# --- the index ------------------------------------------------------------------------------------------------------
class RunIndex:
    """Strings by their run-compressed Burrows-Wheeler transform.

    ``symbols`` are the strings with an end after each (0; bytes count from 1). Ends differ: one stands for its string's number and
    is smaller than any byte. ``runs`` are the symbols of the transform's runs, ``lengths`` their lengths, ``first`` and ``last`` the
    places of the suffixes at their ends. Of the sorted suffixes nothing else is kept.
    """

    #: Symbols of nine bits in one key.
    PACKED = 7

    def __init__(self, data: np.ndarray, bounds: np.ndarray):
        many = len(bounds) - 1
        self.bounds = bounds + np.arange(many + 1)  # with the ends
        n = int(self.bounds[-1])
        self.own = np.repeat(np.arange(many), np.diff(self.bounds))
        byte = np.ones(n, bool)
        byte[self.bounds[1:] - 1] = False
        self.symbols = np.zeros(n, np.int64)
        self.symbols[byte] = data.astype(np.int64) + 1
        self.left = self.bounds[1:][self.own] - 1 - np.arange(n)  # bytes up to the string's end
        self._keys = self._packed()
        suffixes = self._sorted(np.flatnonzero(byte))
        before = np.where(suffixes > 0, self.symbols[suffixes - 1], 0)
        head = np.ones(len(suffixes) + 1, bool)
        head[1:-1] = (before[1:] != before[:-1]) | (before[1:] == 0)
        heads, tails = np.flatnonzero(head[:-1]), np.flatnonzero(head[1:])
        self.runs, self.lengths = before[heads], tails - heads + 1
        self.first, self.last = suffixes[heads], suffixes[tails]

    def _packed(self) -> np.ndarray:
        """Keys of PACKED symbols from each place on, nothing after an end."""
        n = len(self.symbols)
        padded = np.concatenate([self.symbols, np.zeros(self.PACKED, np.int64)])
        keys = np.zeros(n, np.int64)
        for k in range(self.PACKED):
            keys <<= 9
            keys |= np.where(k < self.left, padded[k : n + k], 0)
        return keys

    def _sorted(self, places: np.ndarray) -> np.ndarray:
        """The places in the order of the strings from there on: by PACKED symbols, then by twice as many, and so on, of those only
        that are not yet apart. A rank is that of the first place with equal symbols."""
        order = np.argsort(self._keys[places])
        new = _runs(self._keys[places][order])
        rank = np.zeros(len(self.left), np.int64)  # 0: an end
        rank[places[order]] = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0)) + 1
        alone = np.append(new[1:], True) & new
        open_, size = places[order][~alone], self.PACKED
        while True:
            open_ = open_[self.left[open_] >= size]  # strings that have ended are equal but for their number
            if not len(open_):
                return places[np.lexsort([places, rank[places]])]
            own, next_ = rank[open_], rank[open_ + size]
            order = np.argsort(own * (len(rank) + 1) + next_)
            open_, own, next_ = open_[order], own[order], next_[order]
            new, index = _runs(own, next_), np.arange(len(open_))
            group = np.maximum.accumulate(np.where(_runs(own), index, 0))
            rank[open_] = own + np.maximum.accumulate(np.where(new, index, 0)) - group
            alone = np.append(new[1:], True) & new
            open_ = open_[~alone]
            size *= 2

    def agreement(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many bytes the strings from places a and b on have in common."""
        most = np.minimum(self.left[a], self.left[b])
        out = np.zeros(len(a), np.int64)
        open_ = np.arange(len(a))
        while len(open_):
            differ = self._keys[a[open_] + out[open_]] ^ self._keys[b[open_] + out[open_]]
            same = differ == 0
            ended, differ = open_[~same], differ[~same]
            out[ended] += sum((differ < 1 << 9 * k).astype(np.int64) for k in range(1, self.PACKED))
            open_ = open_[same]
            out[open_] += self.PACKED
            open_ = open_[out[open_] < most[open_]]
        return np.minimum(out, most)

    def matching_statistics(self) -> np.ndarray:
        """For each place how many bytes from there on stand at another place too, in one pass over the strings.

        The neighbour of a run's first suffix is the last of the run before. Inside a run the agreement with the neighbour on that
        side is one less than that of the place before in the text, so the samples at the run ends give all of it. A string's
        first place is a run of its own and takes nothing over from the string before.
        """
        between = self.agreement(self.first[1:], self.last[:-1])
        out = np.zeros(len(self.left), np.int64)
        place = np.arange(len(out))
        for sample, value in ((self.first, np.append(0, between)), (self.last, np.append(between, 0))):
            until = np.zeros(len(out), np.int64)
            until[sample] = value + sample
            held = np.zeros(len(out), np.int64)
            held[sample] = sample
            np.maximum(out, until[np.maximum.accumulate(held)] - place, out)
        return out


def repeated_spans(index: RunIndex, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(string, from, to): bytes covered by substrings of the length that stand at another place too."""
    at = np.flatnonzero((index.matching_statistics() >= length) & (index.left >= length))
    own = index.own[at]
    if not len(at):
        return own, at, at
    new = _runs(own)
    new[1:] |= at[1:] - at[:-1] > length  # substrings that touch are one span
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(at)) - 1
    own = own[first]
    return own, at[first] - index.bounds[own], at[last] - index.bounds[own] + length


def _search(length: int, index_bytes: int) -> Callable:
    """Distinct pieces, sorted by value, to spans (id, from, to) of those that stand once. An index holds whole anchors."""

    def spans(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(held)
        texts = texts_of(rows["piece"].combine_chunks())
        own, begin, end = repeated_spans(RunIndex(texts.data, texts.bounds), length)
        once = rows["n"].to_numpy()[own] == 1
        own, begin, end = own[once], begin[once], end[once]
        start = rows["start"].to_numpy()[own]
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (rows["id"].to_numpy()[own], start + begin, start + end)], names=["id", "from", "to"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, before = [], 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            value = batch.column("value").to_numpy()
            bytes_ = texts_of(batch.column("piece")).bounds
            change = np.flatnonzero(np.append(before is not None and value[0] != before, value[1:] != value[:-1]))
            at, before = 0, value[-1]
            while True:
                # the first change of anchors after which the index is full
                k = np.searchsorted(bytes_[change], index_bytes - size + bytes_[at])
                if k == len(change):
                    break
                held.append(batch.slice(at, change[k] - at))
                yield spans(held)
                held, size, at, change = [], 0, change[k], change[k + 1 :]
            held.append(batch.slice(at))
            size += int(bytes_[-1] - bytes_[at])
        if held:
            yield spans(held)

    return run


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, spans) to (id, removed): spans that touch or overlap are one, in order."""
    for batch in batches:
        if not batch.num_rows:
            continue
        spans = batch.column("spans")
        begin, end = (x.to_numpy(zero_copy_only=False) for x in spans.flatten().flatten())
        row = np.repeat(np.arange(batch.num_rows), np.diff(spans.offsets.to_numpy()))
        order = np.lexsort([begin, row])
        begin, end, row = begin[order], end[order], row[order]
        wide = int(end.max(initial=0)) + 2  # rows apart
        far = np.maximum.accumulate(end + row * wide)
        new = np.ones(len(row), bool)
        new[1:] = begin[1:] + row[1:] * wide > far[:-1]
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(row)) - 1
        values = pa.StructArray.from_arrays([pa.array(begin[first]), pa.array(far[last] - row[last] * wide)], names=["start", "end"])
        yield pa.RecordBatch.from_arrays([batch.column("id"), list_array(np.bincount(row[first], minlength=batch.num_rows), values)], names=["id", "removed"])


# --- the operator ---------------------------------------------------------------------------------------------------
def _dealt(rows: DataFrame, keys: DataFrame, key: str, weight: str, by: list[str], how: str = "inner") -> DataFrame:
    """``rows`` joined to ``keys``, which has each key once and a weight. Keys of more than one in HOT of the weight, HOT of them at
    most, meet their rows in SPREAD tasks, to which a hash of the columns ``by`` deals them."""
    salt, often = fresh(rows.join(keys, key), "salt", "often")
    total = keys.agg(F.sum(weight).alias("n")).first()["n"] or 0
    hot = F.col(weight) * HOT > total
    common = F.broadcast(keys.where(hot).select(key, F.lit(True).alias(often)))
    dealt = rows.join(common, key, "left").withColumn(salt, F.when(F.col(often), F.pmod(F.xxhash64(*by), F.lit(SPREAD))).otherwise(0).cast("int")).drop(often)
    copies = F.when(hot, F.sequence(F.lit(0), F.lit(SPREAD - 1))).otherwise(F.array(F.lit(0)))
    return dealt.join(keys.withColumn(salt, F.explode(copies)), [key, salt], how).drop(salt)


def _all_spans(texts: DataFrame, length: int, crowd: int, step: int, index_bytes: int) -> DataFrame:
    """(id, from, to) of the repeated bytes of distinct texts (id, text, n); they may overlap."""
    found = written(texts.select("id", "text").mapInArrow(_anchor_rows(length, step), "id long, value long, start long, windows long, places long"))
    again = written(found.groupBy("value").agg(F.sum("places").alias("many")).where("many > 1"))
    places = _dealt(found, again, "value", "many", ["id", "start"])
    lists = places.groupBy("id").agg(F.collect_list(F.struct("value", "start", "windows")).alias("found"))
    rows = written(texts.select("id", "text", "n").join(lists, "id").mapInArrow(_cut(length), PIECES))
    spans = [texts.where("n > 1").select("id", F.lit(0).cast("long").alias("from"), F.octet_length("text").cast("long").alias("to"))]
    halvings = (length - ANCHOR).bit_length()
    for level in range(halvings + 1):
        distinct = written(rows.groupBy("value", "digest", "piece", "core", "size").agg(F.sum("n").alias("n"), F.max("id").alias("id"), F.max("start").alias("start")))
        crowded = written(distinct.groupBy("value").agg(F.count("*").alias("pieces")).where(F.col("pieces") > crowd))
        last = level == halvings or crowded.isEmpty()
        few = distinct if last else distinct.join(crowded, "value", "left_anti")
        few = few.select("value", "id", "start", "n", "piece").repartition("value").sortWithinPartitions("value")
        spans.append(written(few.mapInArrow(_search(length, index_bytes), "id long, from long, to long")))
        # a text that stands once may still share whole pieces
        several = distinct.where("n > 1").groupBy("digest").agg(F.sum("n").alias("n"))
        single = rows.where("n = 1").select("id", "digest", F.col("start").alias("from"), (F.col("start") + F.octet_length("piece")).alias("to"))
        spans.append(_dealt(single, several, "digest", "n", ["id", "from"]).select("id", "from", "to"))
        if last:
            break
        split = _dealt(distinct, crowded, "value", "pieces", ["digest"]).select(*_NAMES)
        rows = written(split.mapInArrow(_split(length), PIECES))
    out = spans[0]
    for s in spans[1:]:
        out = out.unionByName(s)
    return out


def kept_bytes(text: Column, removed: Column) -> Column:
    """The bytes of a text outside the spans, one after the other; they need not be UTF-8 any more."""
    data = F.coalesce(text, F.lit("")).cast("binary")
    begins = F.concat(F.array(F.lit(0).cast("long")), F.transform(removed, lambda s: s["end"]))
    ends = F.concat(F.transform(removed, lambda s: s["start"]), F.array(F.octet_length(data).cast("long")))
    parts = F.zip_with(begins, ends, lambda a, b: F.substring(data, (a + 1).cast("int"), (b - a).cast("int")))
    return F.aggregate(parts, F.lit(bytearray()), lambda x, part: F.concat(x, part))


def find_repeats(
    df: DataFrame,
    text: str = "text",
    length: int = LENGTH,
    derive: Callable[[Column, Column], dict[str, Column]] | None = None,
    keep_text: bool = True,
    crowd: int = CROWD,
    step: int = STEP_BYTES,
    index_bytes: int = INDEX_BYTES,
) -> DataFrame:
    """``df`` (without its text, unless ``keep_text``) with ``removed``: the spans (start, end) of the text's UTF-8 bytes that are covered by
    strings of ``length`` bytes which start anywhere else too, in the same text or another; spans that touch are one. Strings are
    judged on the texts as they are and don't cross from one text to the next. ``derive`` may give further columns from the text and the
    spans; they are computed once for equal texts that have a string of the length.

    A null text counts as empty; texts shorter than the length have no spans; repeated rows and equal texts are repeats of each
    other and are removed whole; rows without an id or with extra columns take part as they are; an empty table stays empty. Names that
    ``df`` has get underscores. ``length`` must be at least twice ANCHOR. ``crowd``, ``step`` and ``index_bytes`` bound the
    memory of a task and do not change the result.
    """
    if length < 2 * ANCHOR:
        raise ValueError(f"the length must be at least {2 * ANCHOR}")
    spark, derive = df.sparkSession, derive or (lambda text, removed: {})
    bound_batches(spark)
    none = F.array().cast("array<struct<start:long,end:long>>")
    own = derive(F.coalesce(F.col(text), F.lit("")), none)
    names = fresh(df, "removed", *own)
    key, weight = fresh(df, "text_key", "text_rows")
    with intermediate(spark) as results:
        long = df.select(F.coalesce(F.col(text), F.lit("")).alias("text")).where(F.octet_length("text") >= length)
        texts = written(long.groupBy("text").agg(F.count("*").alias("n")).select(F.monotonically_increasing_id().alias("id"), F.md5("text").alias("key"), "text", "n"))
        merged = _all_spans(texts, length, crowd, step, index_bytes).groupBy("id").agg(F.collect_list(F.struct("from", "to")).alias("spans"))
        merged = merged.mapInArrow(_merge, "id long, removed array<struct<start:long,end:long>>")
        made = [c.alias(name) for name, c in zip(names[1:], derive(F.col("text"), F.col("removed")).values())]
        results.append(texts.join(merged, "id").select(F.col("key").alias(key), F.col("n").alias(weight), F.col("removed").alias(names[0]), *made))
    rows = df.withColumns({key: F.md5(F.coalesce(F.col(text), F.lit("")))} | {f"{key}_{k}": c for k, c in enumerate(own.values())})
    kept = [c for c in df.columns if keep_text or c != text]
    rows = rows.select(*kept, key, *[f"{key}_{k}" for k in range(len(own))])
    hashed = [F.col(f"`{c}`") for c in kept if c != text and rows.schema[c].dataType.typeName() not in ("map", "variant")]
    out = _dealt(rows, results[0], key, weight, hashed or [F.lit(0)], "left")
    values = [F.coalesce(names[0], none).alias(names[0])] + [F.coalesce(name, f"{key}_{k}").alias(name) for k, name in enumerate(names[1:])]
    return out.select(*[F.col(f"`{c}`") for c in kept], *values)
