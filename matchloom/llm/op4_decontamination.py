"""Benchmark decontamination with suffix arrays of the training text.

Documents are taken in shards of about `SHARD` bytes. A shard's words become 64-bit hashes and its word positions are
sorted by the words that follow: a suffix array, ordered by the first `DEPTH` words (a key of four words at first; only
positions that still tie are sorted on). Every suffix of every test item is looked up by binary search, all at once. A
range found is the places of a window; windows found next to each other on one diagonal make a longest verbatim match,
which is reported with its length and place. Nothing is shuffled: each shard answers for its own documents.

Test items reach the executors as broadcast blocks of `BLOCK` bytes of item text each, one block at a time in memory.

Rules: A-Z are lower-cased; a word is a run of digits, letters a-z and characters from U+0080 on. A window is `width`
consecutive words of an item; an item of fewer words, but not none, is one window. Words inside an occurrence are hit.
A document is contaminated when words are hit and they are 1 in `one_in` of its words or more.

Cases: null and empty texts have no words and are clean, an empty item matches nothing; repeated documents and items
each count; no items or no documents give clean documents or no rows; a null item id takes no part; other columns pass
through `clean` untouched, whatever their names; a long text is one shard of its own.
"""

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchloom.llm.shared import small_batches, text_of
from matchloom.llm.words import Letters

WIDTH, ONE_IN, DEPTH = 13, 20, 16
#: Bytes of text in a shard, of words hashed at once, and of item text in a broadcast block.
SHARD, SLICE, BLOCK = 16 << 20, 1 << 20, 4 << 20


def _folded() -> np.ndarray:
    """For each byte its lower-case word character, or 0. In UTF-8 all bytes of U+0080 and above are 0x80 and above."""
    table = np.arange(256, dtype=np.uint8)
    table[0x41:0x5B] += 0x20
    word = (table >= 0x80) | ((table >= 0x30) & (table <= 0x39)) | ((table >= 0x61) & (table <= 0x7A))
    return np.where(word, table, 0).astype(np.uint8)


FOLDED = _folded()


#: The name by which callers get what words are hashed with; its argument is the number of bytes hashed at once.
Powers = Letters


def words_of(data: np.ndarray, starts_of: np.ndarray, powers: Powers) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of texts laid end to end, and for each text the number of its first word.

    starts_of: the texts' first bytes and the end of the last.
    """
    if not len(data):
        return np.empty(0, np.uint64), np.zeros(len(starts_of), np.int64)
    low = FOLDED[data]
    inside = low != 0
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    edges = starts_of[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    first[edges] = inside[edges]
    last[edges - 1] = inside[edges - 1]
    a, b = np.flatnonzero(first), np.flatnonzero(last) + 1
    hashes = powers.hashes(low, a, b)
    return hashes, np.searchsorted(a, starts_of, side="left")


def _buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column without nulls, and the texts' first bytes with the end of the last."""
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None and at[-1] > at[0] else np.empty(0, np.uint8)
    return raw, at - at[0]


class Tests:
    """A block of test items: their words end to end, and every window as a run of them."""

    def __init__(self, items: list[tuple[str, str]], width: int):
        by_text: dict[bytes, list[str]] = {}
        words: list[np.ndarray] = []
        powers = Powers(SLICE)
        for item, text in items:
            raw = np.frombuffer(text.encode(), np.uint8)
            h, _ = words_of(raw, np.array([0, len(raw)]), powers)
            if len(h):
                if (key := h.tobytes()) not in by_text:
                    words.append(h)
                by_text.setdefault(key, []).append(item)
        self.ids = list(by_text.values())
        begin, size, owner, at = [], [], [], 0
        for i, h in enumerate(words):
            n = max(1, len(h) - width + 1)
            begin.append(at + np.arange(n))
            size.append(np.full(n, min(width, len(h))))
            owner.append(np.full(n, i))
            at += len(h) + 1  # a word that is in no document stands between items
        self.words = np.concatenate([np.append(h, np.uint64(0)) for h in words]) if words else np.empty(0, np.uint64)
        self.begin, self.size, self.owner = (np.concatenate(x).astype(np.int64) if x else np.empty(0, np.int64) for x in (begin, size, owner))


def letters(hashes: np.ndarray) -> np.ndarray:
    """The alphabet that suffixes are sorted by: 1 to 65535 for words; 0 is kept for the ends of texts."""
    return hashes % np.uint64(65535) + np.uint64(1)


def suffix_array(alphabet: np.ndarray) -> np.ndarray:
    """Positions in the order of the `DEPTH` letters that start there."""
    n = len(alphabet)
    padded = np.concatenate([alphabet, np.zeros(4, np.uint64)])
    key = padded[:n] << np.uint64(48) | padded[1 : n + 1] << np.uint64(32) | padded[2 : n + 2] << np.uint64(16) | padded[3 : n + 3]
    order = np.argsort(key)
    known = 4
    key = key[order]
    new = np.ones(n, bool)
    new[1:] = key[1:] != key[:-1]
    rank = np.empty(n + DEPTH, np.int64)
    rank[n:] = -1
    rank[order] = np.flatnonzero(new)[np.cumsum(new) - 1]  # a position's rank is where its ties begin
    while known < DEPTH:
        tied = ~new
        tied[:-1] |= ~new[1:]
        slots = np.flatnonzero(tied)
        if not len(slots):
            break
        at = order[slots]
        own, later = rank[at], rank[np.minimum(at + known, n)]
        again = np.lexsort((later, own))
        at, own, later = at[again], own[again], later[again]
        order[slots] = at
        new[slots[1:]] = (own[1:] != own[:-1]) | (later[1:] != later[:-1])
        new[slots[0]] = True
        rank[at] = np.maximum.accumulate(np.where(new[slots], slots, 0))
        known *= 2
    return order


def search(order: np.ndarray, alphabet: np.ndarray, tests: Tests) -> tuple[np.ndarray, np.ndarray]:
    """For every test window the range of the suffix array that starts with it, by binary search over all windows at once."""
    n = len(order)
    padded = np.concatenate([alphabet, np.zeros(DEPTH, np.uint64)])
    wanted = letters(tests.words)

    def compared(here: np.ndarray, which: np.ndarray) -> np.ndarray:
        """-1, 0, 1: the suffixes are before, start with, are after their windows."""
        sign = np.zeros(len(here), np.int8)
        for k in range(int(tests.size.max(initial=0))):
            todo = np.flatnonzero((sign == 0) & (k < tests.size[which]))
            if not len(todo):
                break
            a, b = padded[here[todo] + k], wanted[tests.begin[which[todo]] + k]
            sign[todo] = (a > b).astype(np.int8) - (a < b).astype(np.int8)
        return sign

    def bound(limit: int) -> np.ndarray:
        low, high = np.zeros(len(tests.begin), np.int64), np.full(len(tests.begin), n)
        live = np.flatnonzero(low < high)
        while len(live):
            middle = (low[live] + high[live]) // 2
            right = compared(order[middle], live) < limit
            low[live[right]] = middle[right] + 1
            high[live[~right]] = middle[~right]
            live = live[low[live] < high[live]]
        return low

    return bound(0), bound(1)


def matches(hashes: np.ndarray, order: np.ndarray, alphabet: np.ndarray, tests: Tests) -> tuple[np.ndarray, np.ndarray]:
    """Places and numbers of the windows that occur; all hashed words agree."""
    low, high = search(order, alphabet, tests)
    found = np.flatnonzero(high > low)
    n = (high - low)[found]
    window = np.repeat(found, n)
    slot = np.repeat(low[found] - (np.cumsum(n) - n), n) + np.arange(n.sum())
    place = order[slot]
    padded = np.concatenate([hashes, np.zeros(DEPTH, np.uint64)])
    same = np.ones(len(place), bool)
    for k in range(int(tests.size.max(initial=0))):
        inside = k < tests.size[window]
        same &= ~inside | (padded[place + k] == tests.words[np.minimum(tests.begin[window] + k, len(tests.words) - 1)])
    return place[same], window[same]


def shard_report(raw: np.ndarray, starts_of: np.ndarray, blocks: Iterable[Tests], powers: Powers) -> dict[str, list]:
    """What the columns of `report` hold for the texts of a shard."""
    n_docs = len(starts_of) - 1
    hashed, first = words_of(raw, starts_of, powers)
    n_words = np.diff(first)
    begin = first[:-1] + np.arange(n_docs)  # a free place after each text
    place_of = np.arange(len(hashed)) + np.repeat(np.arange(n_docs), n_words)
    hashes, alphabet = (np.zeros(len(hashed) + n_docs, np.uint64) for _ in range(2))
    hashes[place_of], alphabet[place_of] = hashed, letters(hashed)
    order = suffix_array(alphabet)
    edge = np.zeros(len(hashes) + 1, np.int64)
    items: list[list[str]] = [[] for _ in range(n_docs)]
    longest, longest_at = np.zeros(n_docs, np.int64), np.full(n_docs, -1)
    for tests in blocks:
        place, window = matches(hashes, order, alphabet, tests)
        if not len(place):
            continue
        size = tests.size[window]
        np.add.at(edge, place, 1)
        np.add.at(edge, place + size, -1)
        doc = np.searchsorted(begin, place, side="right") - 1
        for pair in np.unique(doc * len(tests.ids) + tests.owner[window]):
            items[pair // len(tests.ids)] += tests.ids[pair % len(tests.ids)]
        # windows that follow each other in item and document are one longer match
        at = tests.begin[window]
        along = np.lexsort((place, place - at))
        place, at, size, doc = place[along], at[along], size[along], doc[along]
        starts_run = np.ones(len(place), bool)
        starts_run[1:] = (np.diff(place) != 1) | (np.diff(at) != 1)
        run = np.flatnonzero(starts_run)
        ends = np.append(run[1:], len(place)) - 1
        length = place[ends] + size[ends] - place[run]
        best = np.lexsort((-place[run], length, doc[run]))
        doc, length, place = doc[run][best], length[best], place[run][best]
        last = np.append(doc[1:] != doc[:-1], True)
        better = length[last] > longest[doc[last]]
        longest[doc[last][better]] = length[last][better]
        longest_at[doc[last][better]] = (place[last] - begin[doc[last]])[better]
    hit = np.concatenate([[0], np.cumsum(np.cumsum(edge[:-1]) > 0)])
    n_hit = hit[begin + n_words] - hit[begin]
    digests = [hashlib.sha256(",".join(sorted(x)).encode()).hexdigest() for x in items]
    return {
        "n_words": n_words.tolist(), "n_hit": n_hit.tolist(), "n_items": [len(x) for x in items], "items_sha256": digests,
        "longest_match": longest.tolist(), "match_start": [x if x >= 0 else None for x in longest_at.tolist()],
    }


REPORT = "n_words long, n_hit long, n_items long, items_sha256 string, longest_match long, match_start long"


def _blocks(benchmark: DataFrame, id_col: str, text_col: str, width: int) -> list:
    """Broadcast blocks of test items. The driver holds one block at a time."""
    context, out, held, size = benchmark.sparkSession.sparkContext, [], [], 0
    rows = benchmark.select(F.col(id_col).cast("string"), text_of(text_col)).where(F.col(id_col).isNotNull())
    for item, text in rows.toLocalIterator():
        held.append((item, text))
        size += len(text.encode())
        if size >= BLOCK:
            out.append(context.broadcast(Tests(held, width)))
            held, size = [], 0
    return [*out, context.broadcast(Tests(held, width))] if held else out


def _shards(batches: Iterator[pa.RecordBatch], text_at: int) -> Iterator[tuple[list[pa.RecordBatch], pa.Array]]:
    held, texts, size = [], [], 0
    for batch in batches:
        column = batch.column(text_at)
        column = column.cast(pa.string()).fill_null("")
        step = max(1, len(column) * SHARD // max(SHARD, column.nbytes))
        for i in range(0, len(column), step):
            part = column.slice(i, step)
            held.append(batch.slice(i, step))
            texts.append(part)
            at = _buffers(part)[1]
            size += int(at[-1])
            if size >= SHARD:
                yield held, pa.concat_arrays(texts)
                held, texts, size = [], [], 0
    if held:
        yield held, pa.concat_arrays(texts)


def _scan(blocks: list, text_at: int):
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[pa.RecordBatch], dict[str, list]]]:
        powers = Powers(SLICE)
        for held, texts in _shards(batches, text_at):
            raw, at = _buffers(texts)
            yield held, shard_report(raw, at, (b.value for b in blocks), powers)

    return each


def report(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
    width: int = WIDTH, one_in: int = ONE_IN,
) -> DataFrame:
    """Per document its words, hit words, items, the longest verbatim match with its first word, and whether it is contaminated."""
    small_batches(docs.sparkSession)
    scan = _scan(_blocks(benchmark, item_col, item_text_col, width), 1)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held, found in scan(batches):
            ids = pa.concat_arrays([b.column(0) for b in held])
            dirty = [h > 0 and one_in * h >= w for h, w in zip(found["n_hit"], found["n_words"], strict=True)]
            kinds = {"items_sha256": pa.string()}
            columns = [pa.array(v, kinds.get(k, pa.int64())) for k, v in found.items()]
            yield pa.RecordBatch.from_arrays([ids, *columns, pa.array(dirty, pa.bool_())], names=["doc_id", *found, "contaminated"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text")).mapInArrow(rows, f"doc_id {kind}, {REPORT}, contaminated boolean")


def clean(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
    width: int = WIDTH, one_in: int = ONE_IN,
) -> DataFrame:
    """The rows of `docs` that aren't contaminated, with all their columns."""
    small_batches(docs.sparkSession)
    scan = _scan(_blocks(benchmark, item_col, item_text_col, width), docs.columns.index(text_col))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held, found in scan(batches):
            kept, at = np.array([h == 0 or one_in * h < w for h, w in zip(found["n_hit"], found["n_words"], strict=True)], bool), 0
            for batch in held:
                yield batch.filter(pa.array(kept[at : at + batch.num_rows]))
                at += batch.num_rows

    return docs.mapInArrow(rows, docs.schema)
