"""Two-pass external shuffle into shards of equal row counts.

First pass: a seeded hash of each record scatters whole records uniformly into buckets that fit in memory (`BUCKET` bytes
each on average, their number follows the total), and the scattered records are written. Second pass: each bucket is brought
into the order of its hashes and permuted by a seeded Fisher-Yates shuffle, which is what Spark's `shuffle` of an array
does. The buckets laid end to end are a random order of the table; its rows
are dealt to the shards in turn, so shards differ by one row at most. A bucket's first position is the sum of the sizes
of the buckets before it, taken in two levels so that no task sees the sizes of all buckets.

The hash covers the id, the text and the record's place in its partition, so equal texts and even rows repeated whole are
scattered like others. Only DataFrame functions are used.

Cases: a null text counts as empty; null ids and repeated rows are records like others; an empty table gives no rows;
other columns travel along in `shuffled`, inside a struct, whatever their names; a text larger than a bucket makes its
bucket that much larger.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchloom.llm.shared import text_of
from matchloom.session import staged

SHARDS, SEED, BUCKET = 8, 5, 2 << 20
#: Buckets whose sizes are summed in one task.
GROUP = 1024


def size_of(text: Column) -> Column:
    """UTF-8 bytes plus one."""
    return (F.octet_length(text) + 1).cast("long")


def shuffled(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS, seed: int = SEED, bucket_bytes: int = BUCKET) -> DataFrame:
    """record (a struct of all columns), bucket, shard, slot of every row."""
    text = text_of(text_col)
    total = docs.agg(F.sum(size_of(text))).first()[0] or 0
    buckets = max(1, -(-total // bucket_bytes))
    h = F.xxhash64(F.lit(seed), F.col(id_col), text, F.monotonically_increasing_id())
    records = docs.select(h.alias("hash"), F.struct(*[docs[c] for c in docs.columns]).alias("record"))
    scattered = staged(records.withColumn("bucket", F.pmod("hash", F.lit(buckets))), "scattered")
    # one row a bucket: its records in shuffled order
    gathered = scattered.repartition("bucket").sortWithinPartitions("bucket", "hash")
    permuted = gathered.groupBy("bucket").agg(F.shuffle(F.collect_list("record"), F.lit(seed)).alias("records"))
    placed = permuted.select("bucket", F.posexplode("records").alias("place", "record"))
    sizes = scattered.groupBy("bucket").agg(F.count("*").alias("n"))
    rank = placed.join(firsts(sizes), "bucket").withColumn("rank", F.col("first") + F.col("place"))
    return rank.select("record", "bucket", F.pmod("rank", F.lit(shards)).cast("int").alias("shard"), F.floor(F.col("rank") / shards).cast("long").alias("slot"))


def firsts(sizes: DataFrame) -> DataFrame:
    """bucket, first: the number of records in the buckets before it."""
    grouped = sizes.withColumn("group", F.floor(F.col("bucket") / GROUP))
    inside = Window.partitionBy("group").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    groups = grouped.groupBy("group").agg(F.sum("n").alias("n"))
    before = Window.orderBy("group").rowsBetween(Window.unboundedPreceding, -1)  # a row for GROUP buckets
    groups = groups.select("group", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    return grouped.withColumn("inside", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(groups, "group").select("bucket", (F.col("before") + F.col("inside")).alias("first"))


def placement(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Where each document went, without its text."""
    text = F.coalesce(F.col(f"record.{text_col}").cast("string"), F.lit(""))
    return shuffled(docs, id_col, text_col, **options).select(
        F.col(f"record.{id_col}").alias("doc_id"), size_of(text).alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "bucket",
    )


def write(docs: DataFrame, path: str, **options) -> None:
    """Writes the shards, each in the shuffled order, as Parquet folders `shard=n`. Rows keep their columns, with shard and slot."""
    rows = shuffled(docs, **options).select("record", "shard", "slot")
    rows.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
