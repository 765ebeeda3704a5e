"""Exact Jaccard join of documents on word shingles by T-occurrence search (DivideSkip).

A document is the set of its distinct shingles of four words; documents with equal sets form a class, and only classes are
compared. Two linked sets overlap in T shingles or more, T from their sizes. A search takes the inverted list of each of a
set's shingles and divides them: the L longest are put aside, the short ones are merged by a heap, which skips what can't
occur T - L times in them, and the candidates found are probed by binary search in the long lists. Those that reach their T are links.

Spark finds which sets have to meet. Shingles have one order for all documents: rare ones first. Of linked sets the first n - T + l shingles, the prefix, share l or more (l = `SHORT`, or T if that is less). Classes that share no
such shingle with any other are done. The others get a home block, by the shingle of their prefix that most others share;
a block that would hold more than `BLOCK` shingles is dealt into lots. A class goes to each block with which it
shares l prefix shingles, never to single partners. Two blocks that have to meet are a unit: one task builds the inverted index of the one and
searches it for each set of the other. What leaves a unit are counts of links by class and the links that join sets which
the unit hadn't joined yet; never all pairs. So a task holds two blocks, whatever the size of a group of near copies, and no link is
lost: each pair of sets of a group of m is decided in one of its (m / block)^2 / 2 units.

The order is free to choose, since any order gives the same links. A first pass counts, over all documents, in how many classes' prefixes
by hash alone a shingle stands. Those that stand in several come last, the more the later; `HOT` are told apart at most, the most
frequent ones.

Rules: A-Z are lower-cased; words are runs without U+0020 and U+0009 to U+000D. Documents of fewer than four words have
their whole word sequence as one shingle. Documents without words are linked with nothing and are a component each.

Cases: a null or empty text has no words; copies are one class whatever their number and count as each other's links; a row
repeated with its id is a document of its own; a null id never is a component's name unless all ids of the component are null; a
very long text is a block of its own; other columns are not read; an empty table gives no rows.
"""

import hashlib
from bisect import bisect_left
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from itertools import pairwise
from math import log2

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchloom.llm.op10_minhash import components
from matchloom.llm.shared import small_batches, text_of
from matchloom.llm.words import Letters, mixed, shingle_set, spaced_words, texts_of
from matchloom.session import staged

SHINGLE, PERCENT = 4, 85
#: Shared shingles that prefixes must have, shingles in a block, and the bound of shingles that are told apart by their frequency.
SHORT, BLOCK, HOT = 3, 1 << 17, 1 << 21
#: Weighs heap against probes: L = T / (WEIGHT * log2(longest list) + 1).
WEIGHT = 0.0085
#: Classes whose names are broadcast to find their texts; beyond, the texts are joined.
NAMES = 500_000


def least_overlap(n: int, m: int, percent: int) -> int:
    """The least overlap of linked sets of these sizes."""
    return -(-percent * (n + m) // (100 + percent))


class Order:
    """The order of shingles that all documents share: by how often they were seen, in powers of two, then by hash."""

    def __init__(self, shingles: np.ndarray, levels: np.ndarray):
        by = np.argsort(shingles)
        self.shingles, self.levels = shingles[by], levels[by]

    def prefix(self, sets: np.ndarray, percent: int) -> np.ndarray:
        """The first shingles, of which linked sets share `SHORT` or, if less, their least overlap."""
        level = np.zeros(len(sets), np.int8)
        if len(self.shingles):
            at = np.minimum(np.searchsorted(self.shingles, sets), len(self.shingles) - 1)
            level = np.where(self.shingles[at] == sets, self.levels[at], 0)
        least = -(-percent * len(sets) // 100)
        return sets[np.lexsort((mixed(sets ^ np.uint64(0x5851F42D4C957F2D)), level))[: len(sets) - least + min(SHORT, least)]]


BY_HASH = Order(np.empty(0, np.uint64), np.empty(0, np.int8))


class Index:
    """Inverted lists of a block of sets, which are numbered by size."""

    def __init__(self, sets: list[np.ndarray], percent: int):
        self.sizes = np.array([len(s) for s in sets], np.int64)
        self.percent, self.n = percent, len(sets) + 1
        all_of = np.concatenate(sets) if sets else np.empty(0, np.uint64)
        owner = np.repeat(np.arange(len(sets)), self.sizes)
        order = np.argsort(all_of, kind="stable")
        self.shingles, rank = np.unique(all_of[order], return_inverse=True)
        self.owner = owner[order]
        #: a list's number and the set's number in one key, so that one search finds a part of every list
        self.keys = rank * self.n + self.owner

    def linked(self, one: np.ndarray, after: int = -1) -> np.ndarray:
        """Numbers of the sets, from after + 1 on, that are linked with this one."""
        n, percent = len(one), self.percent
        low = max(after + 1, int(np.searchsorted(self.sizes, -(-percent * n // 100))))
        high = int(np.searchsorted(self.sizes, 100 * n // percent, side="right"))
        if low >= high:
            return np.empty(0, np.int64)
        least = least_overlap(n, int(self.sizes[low]), percent)
        rank = np.minimum(np.searchsorted(self.shingles, one), len(self.shingles) - 1)
        rank = rank[self.shingles[rank] == one]
        if len(rank) < least:
            return np.empty(0, np.int64)
        begin, end = np.searchsorted(self.keys, rank * self.n + low), np.searchsorted(self.keys, rank * self.n + high)
        size = end - begin
        live = np.flatnonzero(size)
        if len(live) < least:
            return np.empty(0, np.int64)
        live = live[np.argsort(-size[live], kind="stable")]
        n_long = min(least - 1, int(least / (WEIGHT * log2(max(2, int(size[live[0]]))) + 1)))
        lists = [self.owner[a:b] for a, b in zip(begin[live].tolist(), end[live].tolist(), strict=True)]
        found, count = merge_skip([x.tolist() for x in lists[n_long:]], least - n_long)
        found, count = probed(np.array(found, np.int64), np.array(count, np.int64), lists[:n_long], least)
        return found[100 * count >= percent * (n + self.sizes[found] - count)]


def merge_skip(lists: list[list[int]], least: int) -> tuple[list[int], list[int]]:
    """What stands in `least` of these ascending lists or more, and in how many."""
    heads = [(x[0], i) for i, x in enumerate(lists)]
    heapify(heads)
    at = [0] * len(lists)
    found, count = [], []
    while len(heads) >= least:
        top, taken = heads[0][0], []
        while heads and heads[0][0] == top:
            taken.append(heappop(heads)[1])
        if len(taken) >= least:
            found.append(top)
            count.append(len(taken))
            to = top + 1
        else:
            while len(taken) < least - 1 and heads:
                taken.append(heappop(heads)[1])
            if not heads:
                break  # nothing is left in enough lists
            to = heads[0][0]
        for i in taken:
            at[i] = bisect_left(lists[i], to, at[i])
            if at[i] < len(lists[i]):
                heappush(heads, (lists[i][at[i]], i))
    return found, count


def probed(found: np.ndarray, count: np.ndarray, lists: list[np.ndarray], least: int) -> tuple[np.ndarray, np.ndarray]:
    """Adds the long lists that hold each candidate; those that can't reach `least` any more go."""
    for k, one in enumerate(lists):
        if not len(found):
            break
        at = np.minimum(np.searchsorted(one, found), len(one) - 1)
        count = count + (one[at] == found)
        keep = count + (len(lists) - k - 1) >= least
        if not keep.all():
            found, count = found[keep], count[keep]
    keep = count >= least
    return found[keep], count[keep]


def _sets(column: pa.Array, letters: Letters) -> Iterator[np.ndarray]:
    for raw in texts_of(column):
        yield shingle_set(spaced_words(raw, letters), SHINGLE)


def described(docs: DataFrame, order: Order, id_col: str, text_col: str, percent: int) -> DataFrame:
    """doc_id, mark (a hash of the text), n_shingles, class and prefix (null without words) of each document. No shuffle."""
    small_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.col(text_col)).alias("mark"), text_of(text_col).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(order)  # HOT shingles at most

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters, order = Letters(), shared.value
        for batch in batches:
            size, name, prefix = [], [], []
            for sets in _sets(batch.column(2).cast(pa.string()), letters):
                size.append(len(sets))
                name.append(hashlib.blake2b(sets.tobytes(), digest_size=16).digest() if len(sets) else None)
                prefix.append(order.prefix(sets, percent).view(np.int64) if len(sets) else None)
            columns = [pa.array(size, pa.int64()), pa.array(name, pa.binary()), pa.array(prefix, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], names=["doc_id", "mark", "n_shingles", "class", "prefix"])

    return rows.mapInArrow(each, f"doc_id {kind}, mark long, n_shingles long, class binary, prefix array<long>")


def order_of(rows: DataFrame) -> Order:
    """Puts last the shingles that stand in several classes' prefixes, the more the later; at most `HOT` of them are told apart."""
    of_class = rows.where("class is not null").dropDuplicates(["class"])
    lists = staged(of_class.select(F.explode("prefix").alias("shingle")).groupBy("shingle").agg(F.count("*").alias("n")).where("n > 1"), "lists")
    total = lists.agg(F.sum("n")).first()[0] or 0
    # no more than HOT shingles can stand in 1 / HOT of all rows each
    often = lists.where(F.col("n") >= -(-total // HOT)).select("shingle", F.floor(F.log2("n")).cast("byte").alias("level")).toArrow()
    return Order(often.column(0).to_numpy().view(np.uint64), often.column(1).to_numpy())


def meetings(classes: DataFrame) -> DataFrame:
    """class, high, low, side: the units of two blocks that classes have to go to; side 0 has its home in `low`, side 1 in `high`."""
    rows = staged(classes.select("class", "n_shingles", F.explode("prefix").alias("shingle")), "prefixes")
    lists = staged(rows.groupBy("shingle").agg(F.count("*").alias("n")).where("n > 1"), "lists")
    shared = staged(rows.join(lists, "shingle"), "shared")
    home = shared.groupBy("class").agg(F.max(F.struct("n", "shingle")).alias("top"), F.first("n_shingles").alias("n_shingles"))
    home = staged(home.select("class", "n_shingles", F.col("top.shingle").alias("key")), "home")
    lots = home.groupBy("key").agg(F.ceil(F.sum("n_shingles") / BLOCK).cast("int").alias("lots"))
    # written, so that the joins deal both sides out for themselves and a key with many rows is split
    home = staged(home.join(staged(lots, "lots"), "key").select("class", F.struct("key", F.pmod(F.xxhash64("class"), F.col("lots")).cast("int").alias("lot")).alias("home")), "home")
    placed = staged(shared.join(home, "class").select("class", "n_shingles", "shingle", "home"), "placed")
    blocks = staged(placed.select("shingle", F.col("home").alias("block")).distinct(), "blocks")
    met = placed.join(blocks, "shingle").groupBy("class", "home", "block").agg(F.count("*").alias("n"), F.first("n_shingles").alias("n_shingles"))
    met = met.where(F.col("n") >= F.least(F.lit(SHORT), F.col("n_shingles")))
    side = F.when(F.col("home") > F.col("block"), 1).otherwise(0)
    return met.select("class", F.greatest("home", "block").alias("high"), F.least("home", "block").alias("low"), side.alias("side"))


def with_shingles(docs: DataFrame, classes: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """class, size, weight, shingles: the sorted hashes of each class, from the text of its document `one`; twice if that row is repeated."""
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("text_mark"), text_of(text_col).alias("text"))
    ones = classes.select("class", F.col("n_shingles").alias("size"), "weight", F.col("one.doc_id").alias("one"), F.col("one.mark").alias("mark"))
    ones = F.broadcast(ones) if classes.count() <= NAMES else ones
    found = rows.join(ones, rows["id"].eqNullSafe(ones["one"]) & (rows["text_mark"] == ones["mark"])).select("class", "size", "weight", "text")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = Letters()
        for batch in batches:
            sets = pa.array([s.tobytes() for s in _sets(batch.column(3).cast(pa.string()), letters)], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], sets], names=["class", "size", "weight", "shingles"])

    return found.mapInArrow(each, "class binary, size long, weight long, shingles binary")


def of_units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each unit, which come one after the other."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        unit = batch.column(0).to_numpy(zero_copy_only=False)
        edges = [0, *(np.flatnonzero(unit[1:] != unit[:-1]) + 1).tolist(), len(unit)]
        for begin, end in pairwise(edges):
            if held and held[0].column(0)[0].as_py() != unit[begin]:
                yield pa.Table.from_batches(held).combine_chunks()
                held = []
            held.append(batch.slice(begin, end - begin))
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def links_of_unit(table: pa.Table, percent: int) -> pa.Table:
    """a, b: links that join what wasn't joined; a, n with a null b: the documents of other classes that a is linked with here."""
    names = table.column("class").to_pylist()
    if len(set(names)) < len(names):
        table = table.take(pa.array(sorted({name: i for i, name in enumerate(names)}.values())))
        names = table.column("class").to_pylist()
    side, weight = table.column("side").to_numpy(), table.column("weight").to_numpy()
    sets = [np.frombuffer(x, np.uint64) for x in table.column("shingles").to_pylist()]
    by_size = np.argsort([len(s) for s in sets], kind="stable")
    inner = by_size[side[by_size] == 0]
    outer = by_size[side[by_size] == 1]
    alone = not len(outer)  # a block that meets itself
    index = Index([sets[i] for i in inner], percent)
    count, root = np.zeros(len(sets), np.int64), np.arange(len(sets))
    out: list[tuple] = []
    for k, i in enumerate((inner if alone else outer).tolist()):
        linked = inner[index.linked(sets[i], k if alone else -1)]
        count[i] += weight[linked].sum()
        count[linked] += weight[i]
        for j in linked[np.unique(root[linked], return_index=True)[1]].tolist():
            if root[i] != root[j]:
                root[root == root[j]] = root[i]
                out.append((names[i], names[j], None))
    out += [(names[i], None, int(count[i])) for i in np.flatnonzero(count).tolist()]
    a, b, n = zip(*out, strict=True) if out else ((), (), ())
    return pa.table({"a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary()), "n": pa.array(n, pa.int64())})


def linked_classes(docs: DataFrame, rows: DataFrame, id_col: str, text_col: str, percent: int) -> DataFrame:
    """a, b, n as in `links_of_unit`, of all units. rows: the written table of `described`."""
    classes = rows.where("class is not null").groupBy("class")
    classes = classes.agg(F.first("n_shingles").alias("n_shingles"), F.count("*").alias("weight"), F.min(F.struct("doc_id", "mark")).alias("one"), F.first("prefix").alias("prefix"))
    classes = staged(classes, "classes")
    met = staged(meetings(classes), "meetings")
    units = met.groupBy("high", "low").agg(F.count("*").alias("members")).where("members > 1").select("high", "low")
    met = met.join(staged(units, "units"), ["high", "low"])
    sets = staged(with_shingles(docs, staged(classes.drop("prefix").join(met.select("class").distinct(), "class"), "needed"), id_col, text_col), "sets")
    name = F.concat_ws("/", "high.key", "high.lot", "low.key", "low.lot")
    members = met.join(sets, "class").select(name.alias("unit"), "side", "class", "weight", "shingles")
    members = members.repartition("unit").sortWithinPartitions("unit")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for unit in of_units(batches):
            yield from links_of_unit(unit, percent).to_batches()

    return members.mapInArrow(each, "a binary, b binary, n long")


def joined(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest id reachable by links), n_links (documents it is linked with) of every document."""
    first = staged(described(docs, BY_HASH, id_col, text_col, percent).select("class", "prefix"), "by_hash")
    rows = staged(described(docs, order_of(first), id_col, text_col, percent), "described")
    links = staged(linked_classes(docs, rows, id_col, text_col, percent), "links")
    edges = links.where("b is not null").select("a", "b")
    worded = rows.where("class is not null").select("doc_id", "n_shingles", "class")
    named = worded.groupBy("class").agg(F.min("doc_id").alias("least"), F.count("*").alias("weight"))
    if edges.isEmpty():
        named = named.select("class", F.col("least").alias("component_id"), (F.col("weight") - 1).alias("n_links"))
    else:
        component = staged(components(edges), "components")
        number = links.where("b is null").groupBy(F.col("a").alias("class")).agg(F.sum("n").alias("n"))
        of_linked = staged(component.join(number, "class").join(named, "class"), "linked")
        smallest = of_linked.groupBy("component").agg(F.min("least").alias("component_id"))
        of_linked = of_linked.join(smallest, "component").select("class", "component_id", "n")
        named = named.join(of_linked, "class", "left").select("class", F.coalesce("component_id", "least").alias("component_id"), (F.col("weight") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"))
    out = worded.join(named, "class").select("doc_id", "n_shingles", "component_id", "n_links")
    return out.union(rows.where("class is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(0).cast("long").alias("n_links")))
