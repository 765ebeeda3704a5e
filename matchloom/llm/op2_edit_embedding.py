"""Document fingerprints by randomised edit embedding.

A text walks along a time axis: at each tick a shared random bit of the tick and the present character decides whether
the walk goes on to the next character. What the walk stands on at each tick is the embedded text; after an edit, two
walks fall into step again, so the edit distance of texts shows as the Hamming distance of their embeddings. The bits
repeat after `PERIOD` ticks and depend on a character through `CLASSES` classes.

The fingerprint samples the embedding at ticks shared by all texts: `SAMPLES` ticks of [0, S), of [S, 2S), [2S, 4S) and
so on, one hexadecimal digit each, "." beyond the end. Likeness weighs each such stretch by its ticks, so it estimates
the share of ticks on which two embeddings agree. Bands are keys of `BAND` sampled digits; texts that share a key of a
band are candidates, and candidates are verified by likeness. All work on a text is one pass over its characters.

Cases: null and empty texts have an empty fingerprint and are wholly like each other and not at all like others; equal
texts have equal fingerprints; the next of documents with one id is taken in the order of their texts; a null id comes
after all others; a table of one row is its own next; other columns are not read; an empty table gives no rows.
"""

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate
from operator import getitem, itemgetter

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchloom.llm.shared import small_batches, text_of

PERIOD, CLASSES, SAMPLES, SEED = 4096, 64, 64, 20
#: Sampled digits in a band, bands in a stretch of the fingerprint, and the likeness that verifies a candidate.
BAND, BANDS, LIKE = 8, 8, 0.8
END = "."


class Walk:
    """The shared random walk. A state is a list: by class the next character's state, and at last the state's own tick."""

    def __init__(self, seed: int = SEED):
        random = np.random.default_rng(seed)
        go = random.random((PERIOD, CLASSES)) < 0.5
        go[-1] = True
        ticks = np.where(go, np.arange(PERIOD)[:, None], PERIOD)
        leave = np.minimum.accumulate(ticks[::-1], axis=0)[::-1]  # the tick at which a character is left
        after = ((leave + 1) % PERIOD).tolist()
        self.states: list[list] = [[] for _ in range(PERIOD)]
        for tick, row in enumerate(after):
            self.states[tick] += [self.states[x] for x in row]
            self.states[tick].append(tick)
        digits = random.integers(0, 16, CLASSES)
        self.digit = np.array([ord("0123456789abcdef"[x]) for x in digits], np.uint8)
        self.random = [np.random.default_rng([seed, level]) for level in range(40)]
        self.at: list[np.ndarray] = [np.arange(SAMPLES)]

    def samples(self, level: int) -> np.ndarray:
        """The ticks sampled in a stretch."""
        while len(self.at) <= level:
            k = len(self.at)
            low = SAMPLES << (k - 1)
            self.at.append(np.sort(low + self.random[k].choice(low, SAMPLES, replace=False)))
        return self.at[level]

    def classes(self, text: str) -> np.ndarray:
        codes = np.frombuffer(text.encode("utf-32-le"), "<u4")
        return ((codes * np.uint32(0x9E3779B1)) >> np.uint32(26)).astype(np.uint8)

    def begin(self, classes: np.ndarray, tick: int = 0) -> np.ndarray:
        """The ticks at which each character begins when the first does at `tick`, and that after the last."""
        states = accumulate(classes.tobytes(), getitem, initial=self.states[tick % PERIOD])
        here = np.fromiter(map(itemgetter(CLASSES), states), np.int64, len(classes) + 1)
        return np.concatenate([[tick], tick + np.cumsum((np.diff(here) - 1) % PERIOD + 1)])

    def fingerprint(self, classes: np.ndarray, begin: np.ndarray) -> str:
        out, level, end = [], 0, int(begin[-1])
        while end > (SAMPLES << (level - 1) if level else 0):
            at = self.samples(level)
            live = at[at < end]
            digits = np.full(SAMPLES, ord(END), np.uint8)
            digits[: len(live)] = self.digit[classes[np.searchsorted(begin, live, side="right") - 1]]
            out.append(digits.tobytes())
            level += 1
        return b"".join(out).decode()

    def of(self, text: str) -> str:
        classes = self.classes(text)
        return self.fingerprint(classes, self.begin(classes))


def likeness(a: str, b: str) -> float:
    """Estimated share of ticks, up to the end of the longer text, on which two embeddings agree."""
    if a == b:
        return 1.0
    n = max(len(a), len(b))
    x, y = (np.frombuffer(s.ljust(n, END).encode(), np.uint8).reshape(-1, SAMPLES) for s in (a, b))
    weight = np.array([1 << max(0, k - 1) for k in range(len(x))], float)
    here = ~((x == ord(END)) & (y == ord(END)))
    return float(((x == y) & here).sum(1) @ weight / (here.sum(1) @ weight))


def bands(fingerprint: str) -> set[str]:
    """Keys of bit-sampled bands: for each stretch `BANDS` groups of `BAND` of its digits, ends included."""
    return {f"{k // SAMPLES}:{k}:{fingerprint[k : k + BAND]}" for k in range(0, len(fingerprint), SAMPLES // BANDS)}


def edited(text: str, following: str) -> str:
    """The text whose last half is replaced by as much of the beginning of the following text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


COLUMNS = (
    "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, "
    "candidate_edited boolean, candidate_next boolean"
)


KINDS = (pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.bool_(), pa.bool_())


@dataclass
class Read:
    """A document whose walk is done."""

    ident: pa.Array
    text: str
    group: int
    classes: np.ndarray
    begin: np.ndarray
    mark: str


def compared(walk: Walk, a: Read, b: Read) -> tuple:
    """What `COLUMNS` says of a document and the next one. The edited text's walk goes on from the middle of the document's."""
    half = len(a.text) // 2
    first = len(a.text) - half
    tick = int(a.begin[first])
    rest = walk.begin(b.classes[:half], tick)
    changed = walk.fingerprint(np.concatenate([a.classes[:first], b.classes[:half]]), np.concatenate([a.begin[:first], rest]))
    digest = hashlib.sha256(edited(a.text, b.text).encode()).hexdigest()
    keys = bands(a.mark)
    pairs = [a.mark == other or not keys.isdisjoint(bands(other)) for other in (changed, b.mark)]
    return len(a.text), digest, a.mark, changed, likeness(a.mark, changed), likeness(a.mark, b.mark), *pairs


def in_order(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows dealt into ranges of descending id, each range followed by the first row of the next one (`own` false).

    The bounds come from a look at the ids alone; a range holds about as many rows as any other.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"), F.coalesce(F.col(id_col).cast("double"), F.lit(float("-inf"))).alias("place"))
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cuts = sorted(set(rows.where("doc_id is not null").approxQuantile("place", [i / n for i in range(1, n)], 0.1 / n))) or [0.0]
    rows = Bucketizer(splits=[float("-inf"), *cuts, float("inf")], inputCol="place", outputCol="bucket").transform(rows)
    rows = rows.withColumn("range", F.lit(len(cuts)) - F.col("bucket").cast("int"))
    firsts = {r["range"]: r["place"] for r in rows.groupBy("range").agg(F.max("place").alias("place")).collect()}  # a row a range
    order = sorted(firsts)
    before = {r: order[i - 1] for i, r in enumerate(order)}  # the first range follows the last
    places = F.array(*[F.lit(firsts.get(r)).cast("double") for r in range(len(cuts) + 1)])
    hosts = F.array(*[F.lit(before.get(r)).cast("int") for r in range(len(cuts) + 1)])
    guests = F.when(places[F.col("range")] == F.col("place"), hosts[F.col("range")])
    own = F.struct(F.col("range").alias("range"), F.lit(True).alias("own"))
    guest = F.struct(guests.alias("range"), F.lit(False).alias("own"))
    dealt = rows.select("doc_id", "text", F.explode(F.array(own, guest)).alias("to")).where("to.range is not null").select("doc_id", "text", "to.range", "to.own")
    dealt = dealt.repartitionById(len(cuts) + 1, F.col("range"))  # a partition for each range
    return dealt.sortWithinPartitions("range", F.desc("own"), F.desc_nulls_last("doc_id"), "text")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED) -> DataFrame:
    """Per document its fingerprint, that of its edited text, and their likeness; the likeness to the next document's.

    Whole texts are shuffled once. Within a range each document is followed by its next one.
    """
    small_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walk, held, host = Walk(seed), None, None
        for batch in batches:
            out = []
            for i, (text, group, own) in enumerate(zip(*(batch.column(k).to_pylist() for k in (1, 2, 3)), strict=True)):
                if not own and group == host:
                    continue  # of the rows that share the first id of a range only the first one is next
                host = None if own else group
                classes = walk.classes(text)
                begin = walk.begin(classes)
                present = Read(batch.column(0).slice(i, 1), text, group, classes, begin, walk.fingerprint(classes, begin))
                if held is not None and held.group == group:
                    out.append((held.ident, *compared(walk, held, present)))
                held = present if own else None
            if out:
                names = [x.split()[0] for x in COLUMNS.split(", ")]
                columns = [pa.array([x[k + 1] for x in out], kind) for k, kind in enumerate(KINDS)]
                yield pa.RecordBatch.from_arrays([pa.concat_arrays([x[0] for x in out]), *columns], names=["doc_id", *names])

    return in_order(docs, id_col, text_col).mapInArrow(rows, f"doc_id {kind}, {COLUMNS}")
