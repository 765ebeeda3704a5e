"""Near duplicates by MinHash with sequential Bayesian verification.

A document is the set of its distinct shingles of five words. Documents with equal sets form a class, and only classes
are compared: copies never meet. A class has `HASHES` minima; bands of some of them are its keys, and classes that
share a key are candidates. A pair of candidates goes through three gates: its minima are compared in batches of `BATCH`,
and the pair is dropped as soon as the posterior probability that its similarity reaches the threshold falls below
the gate's part of `MISS` (uniform prior); survivors are verified on the full sets of shingles.

No bucket is expanded into all its pairs. The members of a bucket are first compared with two hubs: the smallest member
and the member that shares most buckets in sum. The links found are closed into components in Spark, by large-star and
small-star steps. Only buckets that still hold several components are looked at again: their members are dealt into
blocks, and members of different components are compared, through the same gates, in the memory of a task that holds two
blocks. Only links leave these tasks, and of them only those that join what the task hasn't joined yet. So components
are those of the full graph of candidates, whatever the size of a bucket.

The chance that a pair at a similarity of t shares no band is (1 - t^rows)^bands; `banding` takes as many bands as bring it to
`MISS` at the threshold: 20 bands of 5 minima at 0.85, 29 or 30 at 0.80. Above, it falls fast. A threshold so low that the
minima don't suffice is refused.

Rules: A-Z are lower-cased; words are runs without U+0020 and U+0009 to U+000D. Documents of fewer than five words have
their whole word sequence as one shingle. Documents without words are linked with nothing and are a component each.

Cases: a null or empty text has no words; equal texts are one class whatever their number; a null id never is a
component's name unless all ids of the component are null, and it is not kept; rows repeated with their id are all
"kept" in `near_duplicates`, of which `deduplicated` leaves one; other columns pass through `deduplicated` untouched; an
empty table gives no rows.
"""

import hashlib
from collections.abc import Iterator
from math import ceil, comb, log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchloom.llm.shared import small_batches, text_of
from matchloom.llm.words import Letters, mixed, shingle_set, spaced_words, texts_of
from matchloom.session import staged

SHINGLE, PERCENT = 5, 85
#: Minima in a band at most, minima of a class, those compared at once, and the chance to miss a link by banding or a gate.
ROWS, HASHES, BATCH, MISS = 5, 192, 16, 1e-5
#: Members of a block that are compared with those of another one in a task's memory.
BLOCK = 256

def shingles(raw: np.ndarray, letters: Letters, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles."""
    return shingle_set(spaced_words(raw, letters), size)


def _coefficients() -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng(10)
    return random.integers(0, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1), random.integers(0, 1 << 63, HASHES, dtype=np.uint64)


def signature(sets: np.ndarray, coefficients: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The least value of each hash over a set."""
    a, b = coefficients
    least = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(sets), 2048):
        part = ((sets[at : at + 2048, None] * a + b) >> np.uint64(32)).astype(np.uint32)
        np.minimum(least, part.min(axis=0), out=least)
    return least


def banding(percent: int = PERCENT, miss: float = MISS) -> tuple[int, int]:
    """Bands and rows of a band such that a pair at the threshold shares no band with the chance `miss` at most."""
    for rows in range(ROWS, 0, -1):
        shared = min(max(percent, 0) / 100, 1.0) ** rows
        bands = 1 if shared == 1 else ceil(log(miss) / log(1 - shared)) if shared else HASHES + 1
        if bands * rows <= HASHES:
            return bands, rows
    raise ValueError(f"{HASHES} minima can't find links at a similarity of {percent} % with a chance of {miss} to miss one")


def keys_of(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """The 64-bit key of each band."""
    part = sig[: bands * rows].reshape(bands, rows).astype(np.uint64)
    h = np.arange(bands, dtype=np.uint64)
    for k in range(rows):
        h = mixed(h * np.uint64(0x9E3779B97F4A7C15) + part[:, k] + np.uint64(1))
    return h.view(np.int64)


def gates(percent: int = PERCENT, miss: float = MISS * BATCH / HASHES) -> list[tuple[int, int]]:
    """(minima compared, least agreements that keep the pair) after each batch; all gates together miss at most `MISS`.

    With a uniform prior, m agreements in n make the similarity a Beta(m+1, n-m+1), whose mass above t is P(Bin(n+1, t) <= m).
    """
    t, out = percent / 100, []
    for n in range(BATCH, HASHES + 1, BATCH):
        total, least = 0.0, n + 1
        for m in range(n + 1):
            total += comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
            if total >= miss:
                least = m
                break
        out.append((n, least))
    return out


def passing(a: np.ndarray, b: np.ndarray, sizes: tuple[np.ndarray, np.ndarray], levels: list[tuple[int, int]], percent: int) -> np.ndarray:
    """Which pairs of rows of signatures pass all gates. Rows that fail one are not compared further.

    The smaller set of a linked pair has `percent` of the larger one's size at least, so sizes are the first gate.
    """
    live = np.flatnonzero(100 * np.minimum(*sizes) >= percent * np.maximum(*sizes))
    agree, done = np.zeros(len(live), np.int64), 0
    for n, least in levels:
        agree = agree + (a[live, done:n] == b[live, done:n]).sum(1)
        keep = agree >= least
        live, agree, done = live[keep], agree[keep], n
    out = np.zeros(len(a), bool)
    out[live] = True
    return out


def _signatures(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, HASHES)


def described(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, mark (a hash of the text), n_shingles, class (null without words), signature of each document. No shuffle."""
    small_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.col(text_col)).alias("mark"), text_of(text_col).alias("text"))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters, coefficients = Letters(), _coefficients()
        for batch in batches:
            size, name, sig = [], [], []
            for raw in texts_of(batch.column(2).cast(pa.string())):
                sets = shingles(raw, letters)
                size.append(len(sets))
                name.append(hashlib.blake2b(sets.tobytes(), digest_size=16).digest() if len(sets) else None)
                sig.append(signature(sets, coefficients).tobytes() if len(sets) else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(size, pa.int64()), pa.array(name, pa.binary()), pa.array(sig, pa.binary())], names=["doc_id", "mark", "n_shingles", "class", "signature"])

    return rows.mapInArrow(each, f"doc_id {kind}, mark long, n_shingles long, class binary, signature binary")


def buckets(classes: DataFrame, percent: int = PERCENT) -> DataFrame:
    """key, class, members, hub for each band key that several classes share; hub: the smallest member."""
    bands, rows_of_band = banding(percent)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sigs = _signatures(batch.column(1))
            keys = np.concatenate([keys_of(s, bands, rows_of_band) for s in sigs]) if len(sigs) else np.empty(0, np.int64)
            owner = pa.array(np.repeat(np.arange(len(sigs)), bands))
            yield pa.RecordBatch.from_arrays([pa.array(keys), batch.column(0).take(owner)], names=["key", "class"])

    rows = classes.select("class", "signature").mapInArrow(each, "key long, class binary")
    shared = rows.groupBy("key").agg(F.count("*").alias("members"), F.min("class").alias("hub")).where("members > 1")
    # written, so that the join deals both sides out for itself and a key with many members is split
    return rows.join(staged(shared, "keys"), "key")


def joined(pairs: DataFrame, rows: DataFrame, *columns: str) -> DataFrame:
    """Adds what `rows` has of both classes of each pair, as a_... and b_...."""
    for side in ("b", "a"):
        pairs = pairs.join(rows.select(F.col("class").alias(side), *[F.col(c).alias(f"{side}_{c}") for c in columns]), side)
    return pairs


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """The last gate: whether two full sets are linked."""
    at = np.minimum(np.searchsorted(a, b), len(a) - 1)
    both = int(np.count_nonzero(a[at] == b))
    return 100 * both >= percent * (len(a) + len(b) - both)


def linked(pairs: DataFrame, described_classes: DataFrame, levels: list[tuple[int, int]], percent: int) -> DataFrame:
    """The pairs that pass all gates."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                sizes = batch.column(4).to_numpy(), batch.column(5).to_numpy()
                keep = passing(_signatures(batch.column(2)), _signatures(batch.column(3)), sizes, levels, percent)
                for i in np.flatnonzero(keep):
                    sets = (np.frombuffer(batch.column(k)[int(i)].as_py(), np.uint64) for k in (6, 7))
                    keep[i] = similar(*sets, percent)
                yield pa.RecordBatch.from_arrays(batch.columns[:2], names=["a", "b"]).filter(pa.array(keep))

    both = joined(pairs, described_classes, "signature", "size", "shingles")
    return both.select("a", "b", "a_signature", "b_signature", "a_size", "b_size", "a_shingles", "b_shingles").mapInArrow(each, "a binary, b binary")


def components(edges: DataFrame) -> DataFrame:
    """class, component (its smallest class) of every class that has an edge, by large-star and small-star steps."""
    edges = staged(edges.select("a", "b").distinct(), "edges")
    state = None
    while True:
        both = edges.union(edges.select("b", "a"))
        least = staged(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m")), "least")  # written: a hub's edges can be split
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct()
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = staged(down.groupBy("a").agg(F.min("b").alias("m")), "least")
        small = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").union(least.select("a", F.col("m").alias("b")))
        edges = staged(small.distinct(), "edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            return edges.select(F.col("a").alias("class"), F.col("b").alias("component")).union(edges.select(F.col("b").alias("class"), F.col("b").alias("component"))).distinct()
        state = now


def across(members: DataFrame, described_classes: DataFrame, levels: list[tuple[int, int]], percent: int) -> DataFrame:
    """a, b: links between classes of one bucket and two components, enough of them to join all that are linked.

    The members of a bucket's largest component need not meet each other. They are dealt into lots of BLOCK, and so are the
    others; each lot of others meets each lot in one task's memory. Two classes that share several buckets meet in that of
    their first common band alone.
    """
    sizes = members.groupBy("key", "component").agg(F.count("*").alias("n"))
    sizes = staged(sizes.groupBy("key").agg(F.max(F.struct("n", "component")).alias("main"), F.sum("n").alias("all")), "sizes")
    lots = lambda n: F.greatest(F.ceil(n / BLOCK), F.lit(1)).cast("int")
    rows = members.join(sizes, "key").select(
        "key", "class", "component", (F.col("component") == F.col("main.component")).alias("is_main"),
        lots(F.col("main.n")).alias("main_lots"), lots(F.col("all") - F.col("main.n")).alias("other_lots"),
    )
    rows = rows.withColumn("lot", F.pmod(F.xxhash64("class"), F.when(F.col("is_main"), F.col("main_lots")).otherwise(F.col("other_lots"))).cast("int"))
    every = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    # x is a lot of the main component, or -1 - a lot of the others; y is a lot of the others
    with_main = F.transform(every("main_lots"), lambda i: F.struct(i.alias("x"), F.col("lot").alias("y")))
    with_others = F.transform(every("other_lots"), lambda j: F.struct((-1 - F.least(j, F.col("lot"))).alias("x"), F.greatest(j, F.col("lot")).alias("y")))
    of_main = F.transform(every("other_lots"), lambda j: F.struct(F.col("lot").alias("x"), j.alias("y")))
    to = F.explode(F.when(F.col("is_main"), of_main).otherwise(F.concat(with_main, with_others)))
    rows = rows.select("key", "class", "component", F.when(F.col("is_main"), -1).otherwise(F.col("lot")).alias("place"), to.alias("to"))
    rows = rows.join(described_classes.select("class", "size", "signature", "shingles"), "class")
    rows = rows.select("key", "to.x", "to.y", F.col("place").alias("lot"), "class", "component", "signature", "size", "shingles").repartition("key", "x", "y").sortWithinPartitions("key", "x", "y")

    banded = banding(percent)

    def compare(table: pa.Table) -> Iterator[tuple[bytes, bytes]]:
        (key, x, y), lot = (table.column(i)[0].as_py() for i in range(3)), table.column(3).to_numpy()
        homes = np.unique(np.array(table.column(5).to_pylist(), object), return_inverse=True)[1]
        right = np.flatnonzero(lot == y)
        left = np.flatnonzero(lot == (-1 if x >= 0 else -1 - x))
        if not len(left) or not len(right) or len(np.unique(homes)) < 2:
            return
        names, sigs, sizes = table.column(4), _signatures(table.column(6)), table.column(7).to_numpy()
        keys = np.stack([keys_of(s, *banded) for s in sigs])
        sets: dict[int, np.ndarray] = {}

        def shingles_of(i: int) -> np.ndarray:
            if i not in sets:
                sets[i] = np.frombuffer(table.column(8)[i].as_py(), np.uint64)
            return sets[i]

        root = homes.copy()  # by member; components joined here get one number
        for i in right.tolist():
            partners = left[root[left] != root[i]]
            if -1 - x == y:
                partners = partners[partners > i]
            same = keys[partners] == keys[i]
            partners = partners[keys[i][np.argmax(same, axis=1)] == key]
            partners = partners[passing(np.broadcast_to(sigs[i], (len(partners), HASHES)), sigs[partners], (np.full(len(partners), sizes[i]), sizes[partners]), levels, percent)]
            for j in partners.tolist():
                if root[i] != root[j] and similar(shingles_of(i), shingles_of(j), percent):
                    root[root == root[j]] = root[i]
                    yield names[i].as_py(), names[j].as_py()

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def answer(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            if found := list(compare(pa.Table.from_batches(parts).combine_chunks())):
                yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*found, strict=True), (pa.binary(), pa.binary()), strict=True)], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            group = np.column_stack([batch.column(i).to_numpy() for i in range(3)])
            edges = [0, *(np.flatnonzero((group[1:] != group[:-1]).any(1)) + 1).tolist(), len(group)]
            for start, end in zip(edges, edges[1:], strict=False):
                part = batch.slice(start, end - start)
                if held and [held[0].column(i)[0].as_py() for i in range(3)] != group[start].tolist():
                    yield from answer(held)
                    held = []
                held.append(part)
        if held:
            yield from answer(held)

    return rows.mapInArrow(each, "a binary, b binary")


def with_shingles(docs: DataFrame, classes: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Adds the sorted hashes of its shingles to each class, from the text of its document `one`."""
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("text_mark"), text_of(text_col).alias("text"))
    ones = classes.select("class", F.col("one.doc_id").alias("one"), F.col("one.mark").alias("mark"))
    found = rows.join(ones, rows["id"].eqNullSafe(ones["one"]) & (rows["text_mark"] == ones["mark"])).select("class", "text")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = Letters()
        for batch in batches:
            sets = [shingles(raw, letters).tobytes() for raw in texts_of(batch.column(1).cast(pa.string()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], names=["class", "shingles"])

    # rows repeated with their id and text give the same class again
    sets = found.mapInArrow(each, "class binary, shingles binary").groupBy("class").agg(F.first("shingles").alias("shingles"))
    return classes.join(sets, "class")


def linked_classes(docs: DataFrame, rows: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame | None:
    """class, component of the classes that have links; None if none has. rows: the written table of `described`."""
    levels = gates(percent)
    classes = rows.where("class is not null").groupBy("class").agg(F.first("signature").alias("signature"), F.first("n_shingles").alias("size"), F.min(F.struct("doc_id", "mark")).alias("one"))
    classes = staged(classes, "classes")
    shared = staged(buckets(classes, percent), "buckets")
    weight = shared.groupBy("class").agg(F.sum("members").alias("weight"))
    if weight.isEmpty():
        return None
    several = staged(classes.join(weight, "class"), "candidates")  # of classes that share a bucket
    strong = shared.join(several.select("class", "weight"), "class").groupBy("key").agg(F.max(F.struct("weight", "class")).alias("strong"))
    strong = staged(strong, "strong")
    star = shared.join(strong, "key").select("class", F.explode(F.array("hub", "strong.class")).alias("hub")).where("class != hub")
    star = star.select(F.greatest("class", "hub").alias("a"), F.least("class", "hub").alias("b")).distinct()

    known = staged(with_shingles(docs, several, id_col, text_col), "shingles")
    edges = staged(linked(star, known, levels, percent), "links")
    component = staged(components(edges), "components")
    home = shared.where("members > 2").join(component, "class", "left").withColumn("component", F.coalesce("component", "class"))
    divided = home.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low != high").select("key")
    divided = staged(divided, "divided")
    more = staged(across(home.join(divided, "key"), known, levels, percent), "links")  # a bucket of two has had its one pair
    return component if more.isEmpty() else staged(components(edges.union(more)), "components")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest id of the component), kept, mark, of every document."""
    rows = staged(described(docs, id_col, text_col), "described")
    links = linked_classes(docs, rows, id_col, text_col, percent)
    if links is None:
        links = rows.select("class", F.col("class").alias("component")).limit(0)
    worded = rows.where("class is not null")
    least = worded.groupBy("class").agg(F.min("doc_id").alias("least"))
    named = least.join(links, "class", "left").withColumn("component", F.coalesce("component", "class"))
    first = links.join(least, "class").groupBy("component").agg(F.min("least").alias("first"))
    named = named.join(first, "component", "left").select("class", F.coalesce("first", "least").alias("component_id"))
    out = worded.join(named, "class").select("doc_id", "n_shingles", "component_id", "mark")
    out = out.union(rows.where("class is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"), "mark"))
    return out.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept"), "mark")


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """The rows of `docs` with one document for each component, with all their columns."""
    found = staged(near_duplicates(docs, id_col, text_col, percent), "near")
    # a row goes as one value, so that no name of its columns meets one of these
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs[id_col].alias("id"), F.xxhash64(docs[text_col]).alias("mark"))

    def same(of: DataFrame) -> Column:
        return rows["id"].eqNullSafe(of["doc_id"]) & (rows["mark"] == of["doc_mark"])

    gone = found.where("not kept and component_id is not null").select("doc_id", F.col("mark").alias("doc_mark")).distinct()
    kept = rows.join(gone, same(gone), "left_anti")
    worded = found.where("n_shingles > 0")
    again = worded.where("kept or component_id is null").groupBy("doc_id", "component_id").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    if again.isEmpty():
        return kept.select("row.*")
    # rows that share id and component, of which any one stays
    again = staged(again.select(F.col("doc_id").alias("again_id"), F.col("component_id").alias("again_component")), "again")
    of_again = worded["doc_id"].eqNullSafe(again["again_id"]) & worded["component_id"].eqNullSafe(again["again_component"])
    marks = worded.join(again, of_again, "left_semi").select("doc_id", F.col("mark").alias("doc_mark"), F.col("component_id").alias("component")).distinct()
    single = kept.join(marks, same(marks), "left_anti").select("row")
    one = rows.join(marks, same(marks)).groupBy("doc_id", "component").agg(F.first("row").alias("row")).select("row")
    return single.union(one).select("row.*")
