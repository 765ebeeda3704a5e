"""Packing of tokenised documents into windows by best-fit decreasing.

A document's token ids, closed by an end id, are cut into full windows and a rest. Pieces go, longest first, into the
open window with the least room that still takes them; a segment tree indexed by remaining capacity finds it. Windows
with the same room are alike, so the plan is made from the number of pieces of each length alone: at most `capacity`
lengths whatever the corpus holds. A step of the plan lays a run of equal pieces into a run of windows that share their
room. Every piece is then ranked among those of its length, in two levels so that a common length is shared out over
many tasks, and finds its step by its rank.

Ids come from `tiktoken` on the same vocabulary and pattern as the `tokenizers` file (tests hold the two against each
other), four times as fast. A special string inside a text becomes its special id, as that library does by default. A text
that `tiktoken` refuses, one with a run of about a million white space characters, is encoded from the `tokenizers` file.

Cases: a null or empty text is the end id alone; a null id stays null; repeated rows are packed each; equal lengths are
ranked by id, start and checksum, and full ties are alike; an empty table gives no rows; other columns are not read.
"""

import base64
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from matchloom.llm.shared import small_batches, text_of
from matchloom.session import staged

CAPACITY, END = 1024, 0
#: Lots that the pieces of a length are ranked in; the counts by length and lot are CAPACITY * LOTS rows at most.
LOTS = 1024
#: Fixed values of the vocabulary: its special string and that string's id.
SPECIAL = {"<|endoftext|>": 50256}


class Tree:
    """A segment tree over 0..capacity that finds the smallest occupied index at or above a given one."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.held = [False] * (2 * self.leaves)

    def put(self, i: int, held: bool) -> None:
        i += self.leaves
        self.held[i] = held
        while i > 1:
            i >>= 1
            self.held[i] = self.held[2 * i] or self.held[2 * i + 1]

    def first(self, low: int) -> int | None:
        i = low + self.leaves
        if self.held[i]:
            return low
        while i > 1:
            if i % 2 == 0 and self.held[i + 1]:
                i += 1
                while i < self.leaves:
                    i = 2 * i + (not self.held[2 * i])
                return i - self.leaves
            i >>= 1
        return None


@dataclass(frozen=True)
class Step:
    """Pieces of `size` with ranks from `rank` on, `each` to a window, go to windows from `window` on at `offset`."""

    size: int
    rank: int
    count: int
    each: int
    window: int
    offset: int


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[list[Step], int]:
    """The steps of best-fit decreasing for so many pieces of each size, and the number of windows."""
    tree, steps, windows = Tree(capacity), [], 0
    room: dict[int, list[tuple[int, int]]] = {}  # remaining capacity: runs (first window, windows)

    def add(left: int, first: int, n: int) -> None:
        if n and left:
            room.setdefault(left, []).append((first, n))
            tree.put(left, True)

    for size in sorted(counts, reverse=True):
        rank, todo = 0, counts[size]
        while todo:
            left = tree.first(size)
            if left is None:
                left = capacity
                first, n = windows, -(-todo // (capacity // size))
                windows += n
            else:
                first, n = room[left].pop()
                if not room[left]:
                    tree.put(left, False)
            each = left // size
            full = min(n, todo // each)
            if full:  # windows that take as many as they can
                steps.append(Step(size, rank, full * each, each, first, capacity - left))
                add(left - each * size, first, full)
                rank, todo, first, n = rank + full * each, todo - full * each, first + full, n - full
            if n and todo:  # the last pieces leave some room in one window
                last = min(todo, each)
                steps.append(Step(size, rank, last, each, first, capacity - left))
                add(left - last * size, first, 1)
                rank, todo, first, n = rank + last, todo - last, first + 1, n - 1
            add(left, first, n)
    return steps, windows


def encoder(ranks_path: str, pattern: str, json_path: str):
    """A function from a text to its ids. json_path: the same vocabulary for `tokenizers`, read when a text needs it."""
    import tiktoken
    from tokenizers import Tokenizer

    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    model = tiktoken.Encoding("byte_bpe_50k", pat_str=pattern, mergeable_ranks=ranks, special_tokens=SPECIAL)
    exact = cache(lambda: Tokenizer.from_file(json_path))

    def encode(text: str) -> list[int]:
        try:
            return model.encode(text, allowed_special="all")
        except ValueError:  # the pattern needs more stack than its engine allows
            return exact().encode(text, add_special_tokens=False).ids

    return encode


def pieces(
    docs: DataFrame, ranks_path: str, pattern: str, json_path: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens of every piece: full windows, then the rest. No shuffle."""
    small_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(ranks_path, pattern, json_path)
        for batch in batches:
            owner, start, length, crc, tokens = [], [], [], [], []
            for i, text in enumerate(batch.column(1)):
                ids = np.array([*encode(text.as_py()), END], "<u4")
                for at in range(0, len(ids), capacity):
                    piece = ids[at : at + capacity]
                    owner.append(i)
                    start.append(at)
                    length.append(len(piece))
                    crc.append(zlib.crc32(piece.tobytes()))
                    tokens.append(len(ids))
            columns = [pa.array(x, pa.int64()) for x in (start, length, crc, tokens)]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(owner, pa.int64())), *columns], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    return rows.mapInArrow(cut, f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long")


def pack(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds sequence_id and offset to pieces. `cut` is read twice, so it should be a written table."""
    lot = F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(LOTS)).cast("int")
    cut = cut.withColumn("lot", lot)
    tallies = staged(cut.groupBy("length", "lot").agg(F.count("*").alias("n")), "lots")
    counts = {r["length"]: r["n"] for r in tallies.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # a row a length
    before = Window.partitionBy("length").orderBy("lot").rowsBetween(Window.unboundedPreceding, -1)
    offsets = tallies.select("length", "lot", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    order = Window.partitionBy("length", "lot").orderBy("doc_id", "start", "ids_crc32")
    ranked = cut.withColumn("row", F.row_number().over(order)).join(offsets, ["length", "lot"])
    ranked = ranked.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("row") - 1 + F.col("before")).cast("long").alias("rank"))

    steps, _ = plan(counts, capacity)
    steps.sort(key=lambda s: (s.size, s.rank))
    size, rank, each, window, offset = (np.array([getattr(s, k) for s in steps], np.int64) for k in ("size", "rank", "each", "window", "offset"))
    first = {int(s): int(i) for i, s in reversed(list(enumerate(size)))}
    last = {int(s): i + 1 for i, s in enumerate(size)}

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, mine = (batch.column(i).to_numpy() for i in (2, 5))
            at = np.empty(len(length), np.int64)
            for s in np.unique(length):
                a, b = first[int(s)], last[int(s)]
                same = length == s
                at[same] = a + np.searchsorted(rank[a:b], mine[same], side="right") - 1
            along = mine - rank[at]
            sequence = window[at] + along // each[at]
            place_in = offset[at] + along % each[at] * length
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(sequence, pa.int64()), pa.array(place_in, pa.int64())], names=PLACED)

    kind = cut.schema["doc_id"].dataType.simpleString()
    return ranked.mapInArrow(place, f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")


PLACED = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def packed(docs: DataFrame, ranks_path: str, pattern: str, json_path: str, capacity: int = CAPACITY) -> DataFrame:
    """Every piece of every document with its window and its place there."""
    return pack(staged(pieces(docs, ranks_path, pattern, json_path, capacity), "pieces"), capacity)
