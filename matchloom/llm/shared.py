"""What several operators of this folder need: bounded batches, columns of whole texts, files that any machine reaches."""

from urllib.parse import urlparse

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

#: Arrow batches that carry whole texts hold at most this many rows and bytes.
BATCH_ROWS, BATCH_BYTES = 1000, 8 << 20


def small_batches(spark: SparkSession) -> None:
    """Bounds the memory that a Python worker needs for a batch of texts."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def text_of(name: str) -> Column:
    """The whole text; null counts as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def filesystem(uri: str):
    """A file system that Python reads and writes on any machine, and the path in it."""
    from pyarrow import fs

    if urlparse(uri).scheme in ("", "file"):
        return fs.LocalFileSystem(), urlparse(uri).path
    return fs.FileSystem.from_uri(uri)
