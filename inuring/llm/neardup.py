"""Near-duplicate documents by a chosen-path set similarity join.

Each text becomes its set of word shingles and a signature of minwise values. Texts of equal sets form a class. Every tree
branches the classes by some of their minwise values: the children of a node are the values that its members have at the
coordinates that the node's own number picks. Members of small nodes are compared with each other. A large node's members
are compared with one of them, its centre; if that leaves its members in more than one component, the node branches
again. Nodes of bounded size whose members are much alike, which branching parts slowly, are compared exhaustively, block
against block on full sets, and so are those left after some levels; larger ones branch on until they are small enough.
Comparisons within a component are left out: they can't change it. Other candidates are first held against their
signatures, then confirmed on full sets.
"""

from __future__ import annotations

from collections import Counter
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inuring.llm.scratch import intermediate, written
from inuring.llm.text import NON_SPACE, Texts, add_columns, fresh, list_array

SHINGLE = 5
#: Least similarity in hundredths.
LEAST = 75
#: Independent trees, coordinates that a node branches by, and minwise values in a signature. Two sets of the least similarity
#: share a first node with probability 1 - 0.25**10; a path of three forks survives in one of the trees with 1 - 0.1**5.
TREES, FORKS, SIGNATURE = 5, 2, 64
#: Levels after which nodes of at most MOST_TOGETHER members are compared exhaustively, and after which every node is: members
#: that share so many values have set similarities well over the least one, so the centre has linked them before.
DEPTH, LAST_DEPTH = 3, 30
#: Members up to which a node is compared exhaustively, at once and in blocks.
SMALL, MOST_TOGETHER = 16, 8192
#: Mean share of signature values that a large node's members have in common with its centre, from which they are compared
#: exhaustively; shingles of a block then, and those that are looked at together.
ALIKE, BLOCK_SHINGLES, COLUMNS = 0.45, 1 << 20, 1 << 15
#: Equal signature values that a candidate needs before full sets are compared: a pair of the least similarity has 48 on
#: average, and fewer than these with a probability below 1e-9.
LEAST_EQUAL = 24
#: Pairs of a class that are compared in one task; a class with more is dealt to several.
PAIRS_A_TASK = 256

_RANDOM = np.random.default_rng(75)
_ODD = lambda n: _RANDOM.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE, _STEP, _PLACE, _LENGTH = _ODD(256), _ODD(1)[0], _ODD(64), _ODD(1)[0]
_XOR, _TIMES = _ODD(SIGNATURE), _ODD(SIGNATURE)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _word_hashes(words: pa.Array) -> np.ndarray:
    """A 64-bit number for each word, the same in every task."""
    offsets = np.frombuffer(words.buffers()[1], np.int32)[: len(words) + 1].astype(np.int64)
    data = np.frombuffer(words.buffers()[2], np.uint8)[: offsets[-1]]
    lengths = np.diff(offsets)
    power = np.cumprod(np.full(int(lengths.max(initial=0)) + 1, _STEP))
    terms = _BYTE[data] * power[np.arange(len(data)) - np.repeat(offsets[:-1], lengths)]
    return _mixed(np.add.reduceat(terms, offsets[:-1]) + lengths.astype(np.uint64) * _LENGTH)


def shingle_sets(texts: Texts, shingle: int = SHINGLE) -> list[np.ndarray]:
    """The sorted distinct shingles of each text, as 64-bit numbers: of ``shingle`` words, or all words of a shorter text."""
    words = texts.words(NON_SPACE, lower=True)
    if not len(words):
        return [np.zeros(0, np.uint64)] * len(texts)
    number, distinct = words.encoded()
    value = _word_hashes(distinct)[number]
    full = np.zeros(len(words), np.uint64)
    for k in range(min(shingle, len(words))):
        full[: len(words) - k] += value[k:] * _PLACE[k % 64]
    full = _mixed(full)
    out = []
    for i, n in enumerate(words.counts.tolist()):
        a = int(words.first[i])
        if n >= shingle:
            out.append(np.unique(full[a : a + n - shingle + 1]))
        elif n:
            out.append(_mixed((value[a : a + n] * _PLACE[:n]).sum(keepdims=True, dtype=np.uint64) + np.full(1, n, np.uint64) * _LENGTH))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def _digest(shingles: np.ndarray) -> bytes:
    """128 bits that tell sets apart."""
    x = _mixed(shingles + _STEP)
    return np.array([x.sum(dtype=np.uint64), _mixed(x ^ _LENGTH).sum(dtype=np.uint64)], np.uint64).tobytes()


def _signature(shingles: np.ndarray) -> np.ndarray:
    least = np.full(SIGNATURE, np.iinfo(np.uint64).max, np.uint64)
    for a in range(0, len(shingles), 8192):
        part = (shingles[a : a + 8192][:, None] ^ _XOR) * _TIMES
        np.minimum(least, part.min(axis=0), out=least)
    return (least >> np.uint64(32)).astype(np.uint32).view(np.int32)


def sketches(df: DataFrame, id: str, text: str, shingle: int = SHINGLE) -> DataFrame:
    """(id, key, n, cls, sig): what to find the row by, the size of its set, the digest and the signature; the last two are null
    for an empty set."""

    def sketch(texts: Texts, _) -> list:
        sets = shingle_sets(texts, shingle)
        sizes = np.array([len(s) for s in sets], np.int64)
        signatures = [_signature(s) for s in sets if len(s)]
        flat = np.concatenate([np.zeros(0, np.int32), *signatures])
        lists = list_array(np.where(sizes > 0, SIGNATURE, 0), pa.array(flat, pa.int32()))
        return [sizes, pa.array([_digest(s) if len(s) else None for s in sets], pa.binary()), lists]

    plain = df.select(F.col(id).alias("id"), F.col(text).alias("text"), _key(id, text).alias("key"), F.xxhash64(text).alias("hash"))
    fields = [T.StructField("n", T.LongType()), T.StructField("cls", T.BinaryType()), T.StructField("sig", T.ArrayType(T.IntegerType()))]
    return add_columns(plain, "text", fields, sketch, drop=("text",))


def _key(id: str, text: str) -> Column:
    """A number to read a row's text by again: of its id, or of the text itself where the id is null. Rows of one number are
    told apart by their class."""
    return F.when(F.col(id).isNotNull(), F.xxhash64(id)).otherwise(F.xxhash64(F.lit(1), text))


def full_sets(df: DataFrame, id: str, text: str, classes: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(cls, shingles) of the classes (cls, key): the texts of their representatives are read again."""
    reps = classes.select("key").distinct()
    texts = df.select(_key(id, text).alias("key"), F.col(text).alias("text")).join(reps, "key", "left_semi")

    def sets(texts: Texts, _) -> list:
        found = shingle_sets(texts, shingle)
        flat = np.concatenate([np.zeros(0, np.uint64), *found]).view(np.int64)
        return [pa.array([_digest(s) if len(s) else None for s in found], pa.binary()), list_array(np.array([len(s) for s in found]), pa.array(flat))]

    fields = [T.StructField("cls", T.BinaryType()), T.StructField("shingles", T.ArrayType(T.LongType()))]
    made = add_columns(texts, "text", fields, sets, drop=("key", "text"))
    return made.join(classes.select("cls"), "cls", "left_semi").groupBy("cls").agg(F.first("shingles").alias("shingles"))


def components(links: DataFrame) -> DataFrame:
    """(cls, root) for each end of the links (a, b): the smallest member of its component, by alternating star contraction.

    Each round replaces a row's links by links to the smallest neighbour, first for the larger, then for the smaller
    neighbours; it ends when the links are stars. No group is gathered: rounds are aggregates and joins.
    """
    edges, before = written(links.select("a", "b").distinct()), None
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = both.join(least, "a").where(F.col("b") > F.col("a")).select(F.col("m").alias("a"), "b").where(F.col("a") != F.col("b"))
        # a < b holds in every link: for b the smaller neighbours are the a
        low = large.groupBy("b").agg(F.min("a").alias("m"))
        joined = large.join(low, "b")
        small = joined.select(F.col("m").alias("a"), F.col("a").alias("b")).union(joined.select(F.col("m").alias("a"), "b")).where(F.col("a") != F.col("b")).distinct()
        edges = written(small)
        now = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if now == before:
            break
        before = now
    return edges.select(F.col("b").alias("cls"), F.col("a").alias("root")).union(edges.select(F.col("a").alias("cls"), F.col("a").alias("root"))).distinct()


def labels(links: DataFrame) -> DataFrame:
    """(cls, root) for each end of the links: the smallest label of its neighbours, where a label is the smallest neighbour.
    Equal roots are in one component; a component may still have several. Cheap enough for each level of the trees."""
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    one = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("root"))
    two = both.join(one.select(F.col("a").alias("b"), "root"), "b").select("a", "root").union(one)
    return two.groupBy(F.col("a").alias("cls")).agg(F.min("root").alias("root"))


def _children(members: DataFrame, deep: bool = False) -> DataFrame:
    """The nodes below: for each fork the coordinate comes from the node's number, the child from the value there. Deep nodes
    fork once, and one in three twice: so members of the least similarity share as many paths below as above, and those of
    a lower one fewer and fewer, however deep it goes."""
    forks = [F.xxhash64("node", F.lit(k), F.element_at("sig", (F.pmod(F.xxhash64(F.lit(k), "node"), F.lit(SIGNATURE)) + 1).cast("int"))) for k in range(FORKS)]
    if deep:
        forks[1:] = [F.when(F.pmod(F.xxhash64(F.lit(-1), "node"), F.lit(3)) == 0, f) for f in forks[1:]]
    return members.select(F.explode(F.array(*forks)).alias("node"), "cls").where("node is not null")


def _roots(classes: DataFrame) -> DataFrame:
    """The first nodes of all trees; tree t branches its root by the coordinates FORKS * t and so on."""
    return classes.select(F.posexplode(F.slice("sig", 1, TREES * FORKS)).alias("k", "v"), "cls").select(F.xxhash64("k", "v").alias("node"), "cls")


def _ordered(a: Column, b: Column) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def _candidates(members: DataFrame, roots: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """Pairs (a, b) to compare, and the large nodes' members, of those nodes that have members in more than one component."""
    named = members if roots is None else members.join(roots, "cls", "left")
    named = named.withColumn("root", F.coalesce("root", "cls") if roots is not None else F.col("cls"))
    nodes = named.groupBy("node").agg(F.count("*").alias("size"), F.min("root").alias("r0"), F.max("root").alias("r1"), F.min(F.struct(F.xxhash64("node", "cls").alias("h"), "cls", "root")).alias("centre"))
    nodes = nodes.where(F.col("r0") != F.col("r1")).drop("r0", "r1")
    inside = named.join(nodes, "node")
    small = inside.where(F.col("size") <= SMALL).groupBy("node").agg(F.collect_set(F.struct("cls", "root")).alias("own"))
    pairs = F.flatten(F.transform("own", lambda x: F.transform(F.filter("own", lambda y: (y["cls"] > x["cls"]) & (y["root"] != x["root"])), lambda y: F.struct(x["cls"].alias("a"), y["cls"].alias("b")))))
    small = small.select(F.explode(pairs).alias("p")).select("p.a", "p.b")
    large = inside.where(F.col("size") > SMALL)
    stars = large.where(F.col("centre.root") != F.col("root")).select(*_ordered(F.col("centre.cls"), F.col("cls")))
    return small.union(stars).distinct(), large.select("node", "cls")


def _alike(large: DataFrame, classes: DataFrame) -> DataFrame:
    """(node) of the large nodes whose members agree with one of them in many signature values."""
    sig = classes.select("cls", "sig")
    centres = large.groupBy("node").agg(F.min("cls").alias("cls")).join(sig, "cls").select("node", F.col("sig").alias("centre"))
    agree = F.aggregate(F.zip_with("sig", "centre", lambda x, y: (x == y).cast("int")), F.lit(0), lambda n, x: n + x)
    return large.join(sig, "cls").join(centres, "node").groupBy("node").agg(F.avg(agree).alias("agree")).where(F.col("agree") >= ALIKE * SIGNATURE).select("node")


def common_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many numbers each left set shares with each right set, by bit sets over those that stand on both sides."""
    number, side = np.concatenate([*left, *right]), np.repeat(np.arange(2), [sum(map(len, left)), sum(map(len, right))])
    row = np.concatenate([np.repeat(np.arange(len(x)), [len(s) for s in x]) for x in (left, right)])
    distinct, column = np.unique(number, return_inverse=True)
    column = column.ravel()
    both = (np.bincount(column[side == 0], minlength=len(distinct)) > 0) & (np.bincount(column[side == 1], minlength=len(distinct)) > 0)
    place = np.cumsum(both) - 1
    keep = both[column]
    column, row, side = place[column[keep]], row[keep], side[keep]
    out = np.zeros((len(left), len(right)), np.int64)
    for first in range(0, int(both.sum()), COLUMNS):
        bits = []
        for k, n in enumerate((len(left), len(right))):
            mine = (side == k) & (column >= first) & (column < first + COLUMNS)
            flags = np.zeros((n, COLUMNS // 8), np.uint8)
            at = column[mine] - first
            np.bitwise_or.at(flags, (row[mine], at >> 3), (1 << (at & 7)).astype(np.uint8))
            bits.append(flags.view(np.uint64))
        for i, x in enumerate(bits[0]):
            out[i] += np.bitwise_count(bits[1] & x).sum(axis=1, dtype=np.int64)
    return out


def _exhaustive(df: DataFrame, id: str, text: str, members: DataFrame, classes: DataFrame, roots: DataFrame, least: int, shingle: int) -> DataFrame:
    """Links (a, b) between members of one node in different components. Nodes are cut into blocks by their shingles; two
    members that share several of the nodes are compared in that of the smallest number."""
    members = members.distinct()
    wanted = classes.join(members.select("cls").distinct(), "cls", "left_semi").select("cls", "key", "n")
    sets = written(full_sets(df, id, text, wanted, shingle))
    sizes = members.join(wanted.select("cls", "n"), "cls").groupBy("node").agg(F.ceil(F.sum("n") / BLOCK_SHINGLES).cast("int").alias("blocks"))
    nodes = members.groupBy("cls").agg(F.array_sort(F.collect_set("node")).alias("nodes"))  # at most one for each path of the trees
    own = members.join(sizes, "node").join(nodes, "cls").join(roots, "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    own = own.withColumn("mine", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    own = own.select("cls", "node", "nodes", "root", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "mine").join(sets, "cls")

    def compare(batch):
        node, i, j = int(batch["node"].iloc[0]), int(batch["i"].iloc[0]), int(batch["j"].iloc[0])
        batch = batch.sort_values("cls", ignore_index=True)
        mine = batch["mine"].to_numpy()
        rows, cols = np.flatnonzero(mine == i), np.flatnonzero(mine == j)
        cls, root = batch["cls"].to_numpy(), np.unique(batch["root"].to_numpy(), return_inverse=True)[1].ravel()
        sets = [np.asarray(x, np.int64) for x in batch["shingles"]]
        n = np.array([len(x) for x in sets])
        lists = [{v for v in x if v < node} for x in batch["nodes"]]
        most = Counter(v for x in lists for v in x).most_common(1)
        done = np.array([bool(most) and most[0][0] in x for x in lists])  # pairs of these are compared elsewhere
        found = set()
        for x, y in ((rows[~done[rows]], cols), (rows[done[rows]], cols[~done[cols]])):
            if len(x) and len(y):
                common = common_counts([sets[k] for k in x], [sets[k] for k in y])
                linked = (100 * common >= least * (n[x][:, None] + n[y] - common)) & (root[x][:, None] != root[y])
                found |= {(min(p, q), max(p, q)) for p, q in zip(x[np.nonzero(linked)[0]].tolist(), y[np.nonzero(linked)[1]].tolist())}
        pairs = [(cls[p], cls[q]) for p, q in sorted(found) if not lists[p] & lists[q]]  # rows are in the order of cls
        return type(batch)(pairs, columns=["a", "b"])

    return own.groupBy("node", "i", "j").applyInPandas(compare, "a binary, b binary").distinct()


def _confirmed(df: DataFrame, id: str, text: str, pairs: DataFrame, classes: DataFrame, least: int, shingle: int) -> DataFrame:
    """The pairs whose full sets are similar enough, after a look at sizes and signatures. A class with many pairs, as a
    centre has, is dealt to several tasks with a copy of its set each."""
    a = classes.select(F.col("cls").alias("a"), F.col("n").alias("na"), F.col("sig").alias("sa"), F.col("key").alias("ka"))
    b = classes.select(F.col("cls").alias("b"), F.col("n").alias("nb"), F.col("sig").alias("sb"), F.col("key").alias("kb"))
    likely = pairs.join(a, "a").join(b, "b").where(100 * F.least("na", "nb") >= least * F.greatest("na", "nb"))
    equal = F.aggregate(F.zip_with("sa", "sb", lambda x, y: (x == y).cast("int")), F.lit(0), lambda n, x: n + x)
    likely = written(likely.where(equal >= LEAST_EQUAL).select("a", "b", "na", "nb", "ka", "kb"))
    ends = likely.select(F.col("a").alias("cls"), F.col("ka").alias("key")).union(likely.select(F.col("b").alias("cls"), F.col("kb").alias("key")))
    wanted = ends.groupBy("cls").agg(F.min("key").alias("key"), F.ceil(F.count("*") / PAIRS_A_TASK).cast("int").alias("parts"))
    wanted = written(wanted)
    sets = full_sets(df, id, text, wanted, shingle).join(wanted.select("cls", "parts"), "cls")
    sets = written(sets.select("cls", "shingles", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")))
    parts = wanted.where("parts > 1").select("cls", "parts")
    for end, other in (("a", "b"), ("b", "a")):
        likely = likely.join(parts.withColumnsRenamed({"cls": end, "parts": f"parts_{end}"}), end, "left")
        likely = likely.withColumn(f"part_{end}", F.coalesce(F.pmod(F.xxhash64(other), F.col(f"parts_{end}")).cast("int"), F.lit(0)))
    of = lambda end, name: sets.select(F.col("cls").alias(end), F.col("part").alias(f"part_{end}"), F.col("shingles").alias(name))
    both = likely.join(of("b", "y"), ["b", "part_b"]).join(of("a", "x"), ["a", "part_a"])
    common = F.size(F.array_intersect("x", "y"))
    return both.withColumn("common", common).where(100 * F.col("common") >= least * (F.col("na") + F.col("nb") - F.col("common"))).select("a", "b")


def _row_components(df: DataFrame, id: str, text: str, least: int, shingle: int) -> DataFrame:
    """(id, hash, n, cls, root) of each row: the hash of its text and the name of its component, null for an empty set."""
    sketch = written(sketches(df, id, text, shingle))
    own = F.min(F.struct(F.col("id").isNull().alias("none"), "key"))["key"]
    classes = written(sketch.where("n > 0").groupBy("cls").agg(own.alias("key"), F.first("n").alias("n"), F.first("sig").alias("sig")))
    links: list[DataFrame] = []
    rest: list[DataFrame] = []
    members = _roots(classes)
    roots = None
    for depth in range(LAST_DEPTH):
        pairs, large = _candidates(members, roots)
        large = written(large)
        links.append(written(_confirmed(df, id, text, pairs, classes, least, shingle)))
        roots = written(labels(reduce(DataFrame.union, links)))
        named = large.join(roots, "cls", "left").groupBy("node").agg(F.count("*").alias("size"), F.min(F.coalesce("root", "cls")).alias("r0"), F.max(F.coalesce("root", "cls")).alias("r1"))
        open_ = written(named.where("r0 != r1").select("node", "size"))
        large = written(large.join(open_.select("node"), "node", "left_semi"))
        if large.isEmpty():
            break
        if depth + 1 == LAST_DEPTH:
            rest.append(large)
            break
        together = open_.where(F.col("size") <= MOST_TOGETHER).select("node")
        if depth + 1 < DEPTH:
            together = together.join(_alike(large, classes), "node", "left_semi")
        together = written(together)
        rest.append(large.join(together, "node", "left_semi"))
        members = written(_children(large.join(together, "node", "left_anti").join(classes.select("cls", "sig"), "cls"), depth + 1 >= DEPTH).distinct())
        if members.isEmpty():
            break
    if rest:
        links.append(written(_exhaustive(df, id, text, written(reduce(DataFrame.union, rest)), classes, roots, least, shingle)))
    roots = written(components(reduce(DataFrame.union, links)))
    return sketch.select("id", "hash", "n", "cls").join(roots, "cls", "left").withColumn("root", F.coalesce("root", "cls"))


def near_duplicates(df: DataFrame, id: str = "doc_id", text: str = "text", least: int = LEAST, shingle: int = SHINGLE) -> DataFrame:
    """(id, n_shingles, component_id) for each row: the size of its shingle set and the smallest id reachable over links.

    Words are runs without white space, after A-Z are lower-cased. Null, empty and blank texts have no shingles and are
    alone: their component is their own id. Rows of equal sets, repeated rows among them, are linked; a null id takes part
    but is never the smallest, so a component of null ids only has a null id. An empty table gives an empty table.
    """
    with intermediate(df.sparkSession) as results:
        rows = written(_row_components(df, id, text, least, shingle))
        smallest = rows.where("root is not null").groupBy("root").agg(F.min("id").alias("component"))
        out = rows.select("id", "n", "root").join(smallest, "root", "left")
        n_shingles, component = fresh(df.select(id), "n_shingles", "component_id")
        results.append(out.select(F.col("id").alias(id), F.col("n").alias(n_shingles), F.when(F.col("root").isNull(), F.col("id")).otherwise(F.col("component")).alias(component)))
    return results[0]


def deduplicate(df: DataFrame, id: str = "doc_id", text: str = "text", least: int = LEAST, shingle: int = SHINGLE) -> DataFrame:
    """One row of ``df`` for each component of near-duplicates, that with the smallest id, with its columns as they were.

    Null ids come last. Rows that share an id are told apart by their texts; of rows equal in both one stays. Rows without
    words are alone and all stay. Different texts are never dropped for sharing an id or having none.
    """
    key, mark = fresh(df, "own_hash", "mark")
    blank = F.col(text).isNull() | ~F.col(text).rlike(r"[^\x20\x09-\x0D]")
    with intermediate(df.sparkSession) as results:
        rows = written(_row_components(df, id, text, least, shingle))
        first = rows.where("root is not null").groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "hash")).alias("p"))
        kept = first.select(F.col("p.id").alias("kept_id"), F.col("p.hash").alias("kept_hash")).distinct()
        same = F.col("id").eqNullSafe(F.col("kept_id")) & (F.col("hash") == F.col("kept_hash"))
        results.append(rows.where("root is not null").join(kept, same).groupBy("kept_id", "kept_hash").agg(F.count("*").alias("kept_rows")))
    kept = results[0].withColumn(mark, F.lit(True))
    hashed = df.withColumn(key, F.when(~blank, F.xxhash64(text)))
    out = hashed.join(kept.withColumnsRenamed({"kept_id": f"{mark}_id", "kept_hash": f"{mark}_hash", "kept_rows": f"{mark}_rows"}), df[id].eqNullSafe(F.col(f"{mark}_id")) & (F.col(key) == F.col(f"{mark}_hash")), "left")
    out = out.where(F.col(mark).isNotNull() | F.col(key).isNull())
    if kept.where("kept_rows > 1").isEmpty():
        return out.select(*df.columns)
    once = F.coalesce(F.col(f"{mark}_rows"), F.lit(1)) == 1
    return out.where(once).select(*df.columns).union(out.where(~once).dropDuplicates([id, key]).select(*df.columns))
