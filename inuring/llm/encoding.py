"""Token-id output: frequency-ranked ids in byte-aligned variable-length code with separate control bytes.

Ids are replaced by their rank by frequency over the whole table, so that the common ones take one byte. Four ranks share a
control byte with two bits each (bytes - 1); the ranks' bytes follow in a column of their own. The files are Parquet tables
of one row a document, in ascending order of ids within and over the files by name, and of the id at each rank. Decoding looks
the control bytes up in a table.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inuring.llm.scratch import remove, temporary
from inuring.llm.text import CHUNK_BYTES, SPACE, Texts, add_columns, byte_table, list_array

#: Distinct pieces of text whose ids a worker keeps at hand.
CACHE_PIECES = 600_000
#: Ranges of document ids that the table is dealt into at most, and ids that their bounds are taken from for each.
MOST_RANGES, IDS_A_RANGE = 20_000, 20
#: White space, or the lead byte of a character that may be.
_MAY_BE_SPACE = SPACE | byte_table([(0xC2, 0xC2), (0xE1, 0xE3)])
_ALNUM = byte_table([(0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A)])
_PUNCTUATION = byte_table([(0x21, 0x7E)]) & ~_ALNUM
_LINE = 0x0A
LENGTHS = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3).astype(np.int64) + 1


class Encoder:
    """Ids of whole texts by a tokenizer of byte-level pieces.

    Its pre-tokens are runs of letters, digits or other signs with at most one leading space, or of white space. So text may
    be cut before a space that a non-space character follows, between an ASCII letter or digit and a sign, and around a
    line end between two such characters, but not inside an added token, without changing an id; equal pieces are encoded once.
    """

    def __init__(self, tokenizer_json: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.vocabulary = self.tokenizer.get_vocab_size(with_added_tokens=True)
        line = self.tokenizer.encode("\n", add_special_tokens=False).ids
        self.line = line[0] if len(line) == 1 else None
        self.whole = [x.content.encode() for x in self.tokenizer.get_added_tokens_decoder().values()]
        self._clear()

    def _clear(self) -> None:
        self.number: dict[bytes, int] = {}
        self.ids, self.first = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def _ids(self, pieces: list[bytes]) -> list[np.ndarray]:
        """The ids of each piece. Pieces are encoded together, a line end between them, which is a token of its own there."""
        out = []
        for a in range(0, len(pieces), 5000):
            part = pieces[a : a + 5000]
            together = b"\n".join(part)
            if self.line is not None and together.count(b"\n") == len(part) - 1:
                ids = np.array(self.tokenizer.encode_batch_fast([together.decode("utf-8", "replace")], add_special_tokens=False)[0].ids, np.uint32)
                ends = np.flatnonzero(ids == self.line)
                if len(ends) == len(part) - 1:
                    first, last = np.concatenate([[0], ends + 1]), np.concatenate([ends, [len(ids)]])
                    out += [ids[x:y] for x, y in zip(first.tolist(), last.tolist())]
                    continue
            out += [np.array(x.ids, np.uint32) for x in self.tokenizer.encode_batch_fast([p.decode("utf-8", "replace") for p in part], add_special_tokens=False)]
        return out

    def _learn(self, pieces: list[bytes]) -> np.ndarray:
        """A number for each of the distinct pieces; new ones are encoded."""
        if len(self.number) > CACHE_PIECES:
            self._clear()
        number = self.number
        new = [p for p in pieces if p not in number]
        plain = [p for p in new if b"\n" not in p]
        new = plain + [p for p in new if b"\n" in p]
        found = self._ids(plain) + self._ids(new[len(plain) :])
        number.update(zip(new, range(len(number), len(number) + len(new))))
        self.ids = np.concatenate([self.ids, *found])
        self.first = np.concatenate([self.first, self.first[-1] + np.cumsum(np.fromiter(map(len, found), np.int64, len(found)))])
        return np.fromiter(map(number.__getitem__, pieces), np.int64, len(pieces))

    def encode(self, texts: Texts, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in turn, each closed by ``end_id``, and how many each has."""
        data, n = texts.data, len(texts)
        may_be_space, alnum, line = _MAY_BE_SPACE[data], _ALNUM[data], data == _LINE
        cut = np.zeros(len(data) + 1, bool)
        cut[:-2] = (data[:-1] == 0x20) & ~may_be_space[1:]
        sign = _PUNCTUATION[data]
        cut[1:-1] |= (alnum[:-1] & sign[1:]) | ((alnum | sign)[:-1] & line[1:])
        cut[2:-1] |= (alnum | sign)[:-2] & line[1:-1] & alnum[2:]  # a longer run of white space is not one token there
        raw = data.tobytes()
        for token in self.whole:  # added tokens are found in the text before it is cut
            at = raw.find(token)
            while at >= 0:
                cut[at + 1 : at + len(token)] = False
                at = raw.find(token, at + 1)
        cut[texts.bounds[:-1]] = True
        cuts = np.flatnonzero(cut[:-1])
        offsets = np.append(cuts, len(data)).astype(np.int32)
        pieces = pa.BinaryArray.from_buffers(pa.binary(), len(cuts), [None, pa.py_buffer(offsets), pa.py_buffer(data)]).dictionary_encode()
        which = self._learn(pieces.dictionary.to_pylist())[pieces.indices.to_numpy(zero_copy_only=False)]
        many = self.first[which + 1] - self.first[which]
        until = np.concatenate([[0], np.cumsum(many)])
        counts = np.diff(until[np.searchsorted(cuts, texts.bounds)]) + 1
        out = np.full(counts.sum(), end_id, np.uint32)
        inner = np.ones(len(out), bool)
        inner[np.cumsum(counts) - 1] = False
        out[inner] = self.ids[np.arange(until[-1]) + np.repeat(self.first[which] - until[:-1], many)]
        return out, counts


_encoders: dict[int, Encoder] = {}


def _encoder(sent) -> Encoder:
    """The worker's encoder for a broadcast tokenizer."""
    key = hash(sent.value)
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(sent.value)
    return _encoders[key]


def pack(values: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Control bytes and data bytes of the documents' values in turn, and how many of each a document has.

    A document is filled up to a multiple of four with zeros, so streams of documents join to one stream.
    """
    padded = -(-counts // 4) * 4
    start = np.cumsum(padded) - padded
    flat = np.zeros(padded.sum(), np.uint32)
    flat[np.arange(len(values)) + np.repeat(start - (np.cumsum(counts) - counts), counts)] = values
    extra = (flat > 0xFF).astype(np.uint8) + (flat > 0xFFFF) + (flat > 0xFFFFFF)
    four = extra.reshape(-1, 4)
    control = (four[:, 0] | four[:, 1] << 2 | four[:, 2] << 4 | four[:, 3] << 6).astype(np.uint8)
    data = flat.astype("<u4").view(np.uint8).reshape(-1, 4)[np.arange(4) <= extra[:, None]]
    until = np.concatenate([[0], np.cumsum(extra.astype(np.int64) + 1)])
    return control, data, padded // 4, until[start + padded] - until[start]


def unpack(control: np.ndarray, data: np.ndarray) -> np.ndarray:
    """All values of a stream, those that fill up documents among them."""
    lengths = LENGTHS[control].ravel()
    at = np.cumsum(lengths) - lengths
    out = data[at].astype(np.uint32)
    for k in (1, 2, 3):
        more = np.flatnonzero(lengths > k)
        out[more] |= data[at[more] + k].astype(np.uint32) << np.uint32(8 * k)
    return out


def _binaries(data: np.ndarray, counts: np.ndarray) -> pa.Array:
    return pa.BinaryArray.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))])


def _raw(column: pa.Array) -> np.ndarray:
    """The bytes of all values of a binary column in turn."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1] if len(column) else [0]
    raw = column.buffers()[2]
    return np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]] if raw is not None else np.zeros(0, np.uint8)


def token_ids(df: DataFrame, text: str, tokenizer, end_id: int, vocabulary: int) -> DataFrame:
    """``df`` without its text, with ``n_tokens`` and ``ids``, little-endian numbers of two bytes where the vocabulary allows, else of four."""
    kind = np.dtype("<u2" if max(vocabulary, end_id + 1) <= 1 << 16 else "<u4")

    def encode(texts: Texts, _) -> list:
        ids, counts = _encoder(tokenizer).encode(texts, end_id)
        return [counts, _binaries(ids.astype(kind).view(np.uint8), counts * kind.itemsize)]

    return add_columns(df, text, [T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType())], encode, limit=2 * CHUNK_BYTES, drop=(text,))


def id_by_rank(ids: DataFrame, kind: np.dtype, size: int) -> np.ndarray:
    """The ids from the most to the least frequent in the whole table; equal counts go by id."""

    def count(batches):
        total = np.zeros(size, np.int64)
        for batch in batches:
            total += np.bincount(_raw(batch.column(0)).view(kind), minlength=size)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"token": seen, "n": total[seen]})

    rows = ids.select("ids").mapInArrow(count, "token long, n long").groupBy("token").agg(F.sum("n").alias("n")).collect()  # a row for each id of the vocabulary at most
    total = np.zeros(size, np.int64)
    for r in rows:
        total[r.token] = r.n
    return np.argsort(-total, kind="stable").astype(np.uint32)


def id_bounds(plain: DataFrame, ranges: int) -> list:
    """At most ``ranges`` - 1 ids that part the table into ranges of about equal size: quantiles of numbers, of other types
    those of a sample by hash. They only balance the files; any bounds give the same order."""
    if ranges < 2:
        return []
    if isinstance(plain.schema["id"].dataType, T.NumericType):
        return sorted(set(plain.agg(F.percentile_approx("id", [k / ranges for k in range(1, ranges)], IDS_A_RANGE * ranges).alias("b")).first()["b"] or []))
    wanted = IDS_A_RANGE * ranges
    rows = plain.where("id is not null").agg(F.count("*").alias("n")).first()["n"]
    some = plain.where("id is not null").where(F.pmod(F.xxhash64("id"), F.lit(max(1, rows // wanted))) == 0).select("id").distinct()
    found = [r["id"] for r in some.orderBy(F.xxhash64("id")).limit(4 * wanted).orderBy("id").collect()]
    return sorted({found[len(found) * k // ranges] for k in range(1, ranges)}) if found else []


def write_tokens(df: DataFrame, path: str, tokenizer_file: str, end_id: int, id: str = "doc_id", text: str = "text") -> None:
    """Encode all texts and write them to ``path``/tokens in ascending order of ids, and the ids by rank to ``path``/ranks.

    Ids may be of any type that has an order. Null ids come first, dealt by a hash of the text; rows of one id are ordered by
    that hash, length and content, so equal rows give the same files in any order. Null and empty texts have the end id only.
    An empty table gives empty files. Texts are encoded once, to a table in the shared folder that is deleted at the end;
    packed ids are shuffled once, to ranges of document ids, a file for each.
    """
    spark = df.sparkSession
    with open(tokenizer_file, encoding="utf-8") as f:
        tokenizer = f.read()
    encoded = f"{path}/encoded"
    try:
        _write_tokens(df, path, encoded, tokenizer, end_id, id, text)
    finally:
        remove(spark, encoded)


def _write_tokens(df: DataFrame, path: str, encoded: str, tokenizer: str, end_id: int, id: str, text: str) -> None:
    spark = df.sparkSession
    vocabulary = Encoder(tokenizer).vocabulary
    size = max(vocabulary, end_id + 1)
    kind = np.dtype("<u2" if size <= 1 << 16 else "<u4")
    sent = spark.sparkContext.broadcast(tokenizer)
    plain = df.select(F.col(id).alias("id"), F.col(text).alias("text"))
    parts = min(MOST_RANGES, int(spark.conf.get("spark.sql.shuffle.partitions")))
    counts = plain.agg(F.count("*").alias("n"), F.count("id").alias("known")).first()
    nulls = -(-parts * (counts["n"] - counts["known"]) // max(counts["n"], 1))
    bounds = id_bounds(plain, max(1, parts - nulls))
    part = F.when(F.col("id").isNull(), F.pmod(F.col("hash"), F.lit(max(nulls, 1))).cast("int")).otherwise(_range(bounds) + nulls)
    ranged = plain.withColumn("hash", F.xxhash64("text")).withColumn("part", part)
    files = nulls + len(bounds) + 1
    token_ids(ranged, "text", sent, end_id, vocabulary).write.option("compression", "zstd").parquet(encoded)
    ids = spark.read.parquet(encoded)
    by_rank = id_by_rank(ids, kind, size)
    rank = np.empty_like(by_rank)
    rank[by_rank] = np.arange(len(by_rank), dtype=np.uint32)
    ranks = spark.sparkContext.broadcast(rank)  # one number for each id of the vocabulary
    spark.createDataFrame([(i, int(x)) for i, x in enumerate(by_rank)], "rank long, token long").coalesce(1).write.parquet(f"{path}/ranks")

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 500):
                part = batch.slice(a, 500)
                get = lambda k: part.column(part.schema.get_field_index(k))  # noqa: B023, E731
                control, data, n_control, n_data = pack(ranks.value[_raw(get("ids")).view(kind)], get("n_tokens").to_numpy(zero_copy_only=False))
                yield pa.RecordBatch.from_arrays([get("id"), get("hash"), get("part"), get("n_tokens"), _binaries(control, n_control), _binaries(data, n_data)], names=["id", "hash", "part", "n_tokens", "control", "data"])

    schema = T.StructType([*ids.drop("ids").schema.fields, T.StructField("control", T.BinaryType()), T.StructField("data", T.BinaryType())])
    in_order = ids.mapInArrow(packed, schema).repartitionById(files, F.col("part")).sortWithinPartitions("part", "id", "hash", "n_tokens", "control", "data")

    def running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, done = None, 0
        for batch in batches:
            own = batch.column(batch.schema.get_field_index("part")).to_numpy(zero_copy_only=False)
            counts = batch.column(batch.schema.get_field_index("n_tokens")).to_numpy(zero_copy_only=False)
            if not len(own):
                continue
            before = np.cumsum(counts) - counts
            first = np.searchsorted(own, own)  # parts are in order within a partition
            before -= before[first]
            if own[0] == part:
                before[own == part] += done
            part, done = own[-1], int(before[-1] + counts[-1])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(before)], names=[*batch.schema.names, "before"])

    schema = T.StructType([*schema.fields, T.StructField("before", T.LongType())])
    in_order.mapInArrow(running, schema).write.option("compression", "zstd").parquet(f"{path}/tokens")


def _range(bounds: list) -> Column:
    """How many of the sorted bounds lie below the id, found among every 64th first."""
    below = lambda values: F.aggregate(F.array(*[F.lit(b) for b in values]) if isinstance(values, list) else values, F.lit(0), lambda k, b: k + (F.col("id") > b).cast("int"))
    if not bounds:
        return F.lit(0)
    block = below(bounds[::64])
    rows = F.array(*[F.array(*[F.lit(b) for b in bounds[a : a + 64]]) for a in range(0, len(bounds), 64)])
    return F.when(block == 0, F.lit(0)).otherwise((block - 1) * 64 + below(F.element_at(rows, F.greatest(block, F.lit(1)))))


def read_tokens(spark: SparkSession, path: str, ids: bool = True) -> DataFrame:
    """(id, start, n_tokens, ids_crc32[, tokens]) of each document in the files: the ids of all documents before it, its own
    with the end id, the crc32 of those as little-endian unsigned 32-bit numbers, and on demand the ids themselves."""
    by_rank = np.array([r.token for r in spark.read.parquet(f"{path}/ranks").orderBy("rank").collect()], np.uint32)  # as many as the vocabulary
    sent = spark.sparkContext.broadcast(by_rank)
    tokens = spark.read.parquet(f"{path}/tokens")
    sums = tokens.groupBy("part").agg(F.sum("n_tokens").alias("own")).orderBy("part").collect()  # MOST_RANGES rows at most
    offsets, total = [], 0
    for r in sums:
        offsets.append((r.part, total))
        total += r.own
    starts = F.broadcast(spark.createDataFrame(offsets, "part int, offset long"))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            get = lambda k: batch.column(batch.schema.get_field_index(k))  # noqa: B023, E731
            counts = get("n_tokens").to_numpy(zero_copy_only=False)
            padded = -(-counts // 4) * 4
            values = sent.value[unpack(_raw(get("control")), _raw(get("data")))].astype("<u4")
            start = np.cumsum(padded) - padded
            crc = np.array([zlib.crc32(values[a : a + n]) for a, n in zip(start.tolist(), counts.tolist())], np.int64)
            made = [get("id"), get("part"), get("before"), get("n_tokens"), pa.array(crc)]
            if ids:
                real = np.arange(counts.sum()) + np.repeat(start - (np.cumsum(counts) - counts), counts)
                made.append(list_array(counts, pa.array(values[real].astype(np.int64))))
            yield pa.RecordBatch.from_arrays(made, names=["id", "part", "before", "n_tokens", "ids_crc32", "tokens"][: len(made)])

    kind = tokens.schema["id"].dataType.simpleString()
    schema = f"id {kind}, part int, before long, n_tokens long, ids_crc32 long" + ", tokens array<long>" * ids
    out = tokens.mapInArrow(decode, schema).join(starts, "part")
    return out.select("id", (F.col("offset") + F.col("before")).alias("start"), "n_tokens", "ids_crc32", *["tokens"] * ids)


def token_output(df: DataFrame, tokenizer_file: str, end_id: int, id: str = "doc_id", text: str = "text", path: str | None = None, ids: bool = False) -> DataFrame:
    """Write the table's tokens to ``path`` and read the files back; see both. Without a path they go to a new shared folder that
    is removed when the program ends."""
    path = path or temporary(df.sparkSession)
    write_tokens(df, path, tokenizer_file, end_id, id, text)
    return read_tokens(df.sparkSession, path, ids)
