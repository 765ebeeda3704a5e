"""Ranked lexical search of all documents for each item of a query set, by length-ordered impact vectors (LEMP).

A document is a sparse vector of impacts: for each term w * ((SCALE * tf) div (1000 * tf + 8 * m)), in 64-bit integers. A score is the inner
product with the item's term counts. For the bounds both vectors are scaled by the root of w, which leaves products as they are.

Vectors are ordered by length over all documents, by ranges, and read in buckets of `BUCKET`, longest first. For an item whose
`top`-th best score so far is s, a bucket with |item| * longest < s can't hold a better document (Cauchy-Schwarz), nor can any later one
of the range. Inside a bucket, the item's heaviest `FOCUS` coordinates bound what a document must have: each coordinate of a normalised
vector lies within an angle of the item's, and the product on the focus plus the product of the remaining lengths has to
reach s. Documents that pass are scored exactly in integers; ties with the `top`-th are kept until the end. The longest vectors are searched
first, in a job of their own, and their scores are the s that all other ranges begin with.

Items are taken in blocks of about `BLOCK` bytes of text, each against all documents. Tasks read a block's items from the shared folder; through the
driver go a block's weights and thresholds, bounded by the block. Only terms of the block's items are kept of a document.

Terms: runs of digits, letters and characters from U+0080 on, A-Z lower-cased; N, L, n, df, w, m and the score as `weights` and `impacts`
state them.

Cases: a null or empty text has no terms, is found by no item and finds nothing as one; repeated documents are ranked each, those of equal
score by ascending id, null ids last; rows of one item id and one text are one item, one id with two texts are two; documents without
a term of the item have no score and aren't returned; empty tables give no rows; other columns are not read; a very long text is one vector.
"""

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.dataset as ds
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from matchloom.llm.shared import filesystem, small_batches, text_of
from matchloom.session import shared_path, staged

TOP, SCALE, SHARE = 10, 1_000_000_000, 75
#: Documents in a bucket, an item's coordinates that bound, bytes of items in a block, and the share of vectors that is searched first.
BUCKET, FOCUS, BLOCK, FIRST = 2048, 6, 4 << 20, 0.02
#: Bounds are floats: they are loosened by this much.
SLACK = 1e-6


def _folded() -> bytes:
    """For each byte its lower-case term character, or a space. In UTF-8 all bytes of U+0080 and above are 0x80 and above."""
    lower = bytes(range(256)).lower()
    return bytes(c if c >= 0x80 or chr(c).isalnum() else 0x20 for c in lower)


FOLDED = _folded()


def terms(text: str) -> list[bytes]:
    return text.encode().translate(FOLDED).split()


class Items:
    """A block of items: the term counts of each, terms being numbered."""

    def __init__(self, texts: list[str]):
        counts = [Counter(terms(t)) for t in texts]
        self.number = {t: i for i, t in enumerate(sorted(set().union(*counts)))}
        self.terms = [np.array([self.number[t] for t in c], np.int64) for c in counts]
        self.times = [np.array(list(c.values()), np.int64) for c in counts]

    @classmethod
    def read(cls, folder: str) -> "Items":
        files, path = filesystem(folder)
        rows = ds.dataset(path, format="parquet", filesystem=files).to_table(columns=["item", "text"]).sort_by("item")
        return cls(rows.column("text").to_pylist())


def weights(df: np.ndarray, documents: int) -> np.ndarray:
    """floor(1000 * ln((2N + 2) / (2 df + 1))) of each term, in doubles."""
    return np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * x + 1))) for x in df.tolist()], np.int64)


def impacts(weight: np.ndarray, tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """w * ((SCALE * tf) div (1000 * tf + 8 * m))."""
    return weight * ((SCALE * tf) // (1000 * tf + 8 * m))


def length_norm(n: np.ndarray, documents: int, length: int) -> np.ndarray:
    """m of documents of n terms: 100 - SHARE + ((SHARE * n * N) div L)."""
    return np.array([100 - SHARE + (SHARE * x * documents) // length for x in n.tolist()], np.int64)


def in_blocks(items: DataFrame, item_col: str, text_col: str) -> tuple[DataFrame, str, int]:
    """The written table (block, item, item_id, text), its folder, and the number of blocks. item counts from 0 in each block."""
    rows = items.select(F.col(item_col).alias("item_id"), text_of(text_col).alias("text")).distinct()
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-size // BLOCK))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(n)).cast("int"))
    in_order = Window.partitionBy("block").orderBy("item_id", "text")
    rows = rows.withColumn("item", F.row_number().over(in_order) - 1)
    folder = shared_path(items.sparkSession, "items")
    rows.write.partitionBy("block").parquet(folder)
    return items.sparkSession.read.schema("item_id " + items.schema[item_col].dataType.simpleString() + ", text string, item int, block int").parquet(folder), folder, n


def described(docs: DataFrame, folder: str, id_col: str, text_col: str) -> DataFrame:
    """doc_id, n (its terms), terms, tf: of each document those that the block's items have. No shuffle."""
    small_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = Items.read(folder).number
        for batch in batches:
            n, found, times = [], [], []
            for text in batch.column(1).to_pylist():
                all_of = terms(text)
                count = Counter(all_of)
                n.append(len(all_of))
                known = count.keys() & number.keys()
                found.append([number[t] for t in known])
                times.append([count[t] for t in known])
            columns = [pa.array(n, pa.int64()), pa.array(found, pa.list_(pa.int32())), pa.array(times, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["doc_id", "n", "terms", "tf"])

    return docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text")).mapInArrow(each, f"doc_id {kind}, n long, terms array<int>, tf array<long>")


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The values of a list column end to end and where each list begins, with the end of the last."""
    column = column.cast(pa.list_(column.type.value_type))
    return column.flatten().to_numpy(), np.concatenate([[0], np.cumsum(column.value_lengths().to_numpy())])


class Bucket:
    """Vectors of like length: their postings by term, with exact impacts."""

    def __init__(self, batch: pa.RecordBatch, weight: np.ndarray, documents: int, length: int):
        ids, at = _lists(batch.column(2))
        tf, _ = _lists(batch.column(3))
        rows = np.repeat(np.arange(batch.num_rows), np.diff(at))
        m = length_norm(batch.column(1).to_numpy(), documents, length)
        order = np.argsort(ids, kind="stable")
        self.term, self.row = ids[order], rows[order]
        self.impact = impacts(weight[ids], tf, m[rows])[order]
        self.scaled = self.impact / np.sqrt(np.maximum(weight[self.term], 1))
        self.norm = np.sqrt(np.bincount(self.row, self.scaled**2, batch.num_rows))
        self.longest = float(self.norm.max(initial=0.0))
        self.n = batch.num_rows
        self.doc_id = batch.column(0)

    def postings(self, term: int) -> slice:
        return slice(*np.searchsorted(self.term, [term, term + 1]))


class Item:
    """An item's vector, and the best scores found for it so far."""

    def __init__(self, ids: np.ndarray, times: np.ndarray, weight: np.ndarray, least: int, top: int):
        known = weight[ids] > 0
        self.ids, self.times = ids[known], times[known]
        vector = self.times * np.sqrt(weight[self.ids])
        self.norm = float(np.sqrt((vector**2).sum()))
        order = np.argsort(-vector, kind="stable")
        self.ids, self.times, self.unit = self.ids[order], self.times[order], vector[order] / (self.norm or 1.0)
        self.least, self.top = least, top
        self.best: list[tuple] = []  # score, doc_id
        self.done = not len(self.ids)

    def candidates(self, bucket: Bucket) -> np.ndarray:
        """Which documents may reach the score that counts."""
        if self.least <= 0:
            return np.ones(bucket.n, bool)
        needed = np.minimum(self.least * (1 - SLACK) / (self.norm * bucket.norm), 1.0)  # cosine that each document needs
        angle = math.acos(min(1.0, self.least * (1 - SLACK) / (self.norm * bucket.longest)))
        live = bucket.norm * self.norm >= self.least * (1 - SLACK)
        product, square = np.zeros(bucket.n), np.zeros(bucket.n)
        for term, unit in zip(self.ids[:FOCUS].tolist(), self.unit[:FOCUS].tolist(), strict=True):
            at = bucket.postings(term)
            x = np.zeros(bucket.n)
            x[bucket.row[at]] = bucket.scaled[at] / bucket.norm[bucket.row[at]]
            own = math.acos(min(1.0, unit))
            low, high = math.cos(min(math.pi, own + angle)), math.cos(max(0.0, own - angle))
            live &= (x >= low - SLACK) & (x <= high + SLACK)
            product += unit * x
            square += x * x
        rest = math.sqrt(max(0.0, 1 - float((self.unit[:FOCUS] ** 2).sum())))
        return live & (product + rest * np.sqrt(np.maximum(0.0, 1 - square)) >= needed - SLACK)

    def search(self, bucket: Bucket) -> None:
        if self.done:
            return
        if self.norm * bucket.longest < self.least * (1 - SLACK):
            self.done = True  # all that follow are shorter
            return
        live = self.candidates(bucket)
        if not live.any():
            return
        score = np.zeros(bucket.n, np.int64)
        for term, times in zip(self.ids.tolist(), self.times.tolist(), strict=True):
            at = bucket.postings(term)
            rows = bucket.row[at]
            keep = live[rows]
            score[rows[keep]] += times * bucket.impact[at][keep]  # a document is once in a list
        rows = np.flatnonzero(score >= max(1, self.least))
        self.best += zip(score[rows].tolist(), bucket.doc_id.take(pa.array(rows)).to_pylist(), strict=True)
        if len(self.best) >= self.top:
            scores = sorted((b[0] for b in self.best), reverse=True)
            self.least = max(self.least, scores[self.top - 1])
            self.best = [b for b in self.best if b[0] >= self.least]


def found(vectors: DataFrame, folder: str, weight: np.ndarray, documents: int, length: int, least: np.ndarray, top: int) -> DataFrame:
    """item, doc_id, score: the best of each range of vectors, ties with the last one included."""
    spark = vectors.sparkSession
    kind, id_type = vectors.schema["doc_id"].dataType.simpleString(), to_arrow_type(vectors.schema["doc_id"].dataType)
    shared = spark.sparkContext.broadcast((weight, least))  # as long as the block's terms and items

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, (known, begin) = Items.read(folder), shared.value
        w = np.zeros(len(block.number), np.int64)  # 0 for terms that no document has
        w[: len(known)] = known
        items = [Item(ids, times, w, int(s), top) for ids, times, s in zip(block.terms, block.times, begin.tolist(), strict=True)]
        for batch in batches:
            for at in range(0, batch.num_rows, BUCKET):
                bucket = Bucket(batch.slice(at, BUCKET), w, documents, length)
                for item in items:
                    item.search(bucket)
        for i, item in enumerate(items):
            if item.best:
                score, ids = zip(*item.best, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array([i] * len(ids), pa.int32()), pa.array(ids, id_type), pa.array(score, pa.int64())], names=["item", "doc_id", "score"])

    return vectors.mapInArrow(each, f"item int, doc_id {kind}, score long")


def best_of(rows: DataFrame, top: int) -> DataFrame:
    in_order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return rows.withColumn("rank", F.row_number().over(in_order)).where(F.col("rank") <= top)


def search_block(docs: DataFrame, folder: str, n_items: int, id_col: str, text_col: str, top: int) -> DataFrame:
    """item, rank, doc_id, score of the items of one block."""
    rows = staged(described(docs, folder, id_col, text_col), "terms")
    documents, length = rows.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = rows.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df")).toArrow()
    counts = np.zeros(max(df.column("term").to_pylist(), default=-1) + 1, np.int64)
    counts[df.column("term").to_numpy()] = df.column("df").to_numpy()
    weight = weights(counts, documents)
    weight = np.where(counts > 0, weight, 0)

    def lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value
        for batch in batches:
            norm = Bucket(batch, w, documents, length).norm
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(norm)], names=["doc_id", "n", "terms", "tf", "norm"])

    shared = docs.sparkSession.sparkContext.broadcast(weight)
    kind = rows.schema["doc_id"].dataType.simpleString()
    vectors = rows.where("size(terms) > 0").mapInArrow(lengths, f"doc_id {kind}, n long, terms array<int>, tf array<long>, norm double")
    vectors = staged(vectors.where("norm > 0"), "vectors")  # terms of weight 0 give no score
    cut = vectors.agg(F.percentile_approx("norm", F.lit(1 - FIRST), F.lit(1000))).first()[0]
    none = np.zeros(n_items, np.int64)
    # copies have one length, so the hash of the row parts them
    ordered = lambda part: part.repartitionByRange(F.desc("norm"), F.xxhash64("doc_id", "n")).sortWithinPartitions(F.desc("norm"))
    columns = ["doc_id", "n", "terms", "tf"]
    first = staged(best_of(found(ordered(vectors.where(F.col("norm") >= F.lit(cut))).select(*columns), folder, weight, documents, length, none, top), top), "first")
    least = none.copy()
    for item, score in first.where(F.col("rank") == top).select("item", "score").toArrow().to_pandas().itertuples(index=False):
        least[item] = score
    rest = found(ordered(vectors.where(F.col("norm") < F.lit(cut))).select(*columns), folder, weight, documents, length, least, top)
    return best_of(first.select("item", "doc_id", "score").union(rest), top)


def ranked(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", top: int = TOP) -> DataFrame:
    """item_id, rank, doc_id, score: the `top` best documents of each item."""
    table, folder, n_blocks = in_blocks(items, item_col, item_text_col)
    out = None
    for block in range(n_blocks):
        own = table.where(F.col("block") == block)
        n_items = own.count()
        if not n_items and (n_blocks > 1 or out is not None):
            continue
        if not n_items:
            return own.select("item_id", F.lit(0).alias("rank"), F.lit(None).cast(docs.schema[id_col].dataType).alias("doc_id"), F.lit(0).cast("long").alias("score")).limit(0)
        best = search_block(docs, f"{folder}/block={block}", n_items, id_col, text_col, top)
        best = staged(best, "best").join(own.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")
        out = best if out is None else out.union(best)
    return out
