"""WARC archives and an external merge of their capture index.

`write_archives` writes a record for each page; every task writes an archive of its own, one gzip member a record, into
the shared folder and returns its name, so a repeated task only leaves a file that no one reads. Of records with equal
payloads of `LEAST` bytes or more the one with the smallest id is a response, the others are revisits of it.

`read_runs` reads archives back, checks each digest and writes the captures of an archive, sorted by URL key, time and id,
as a run. `merge_runs` merges the runs by a loser tree into one order: bounds from a bounded sample of keys cut the key
space into ranges, a task merges a range of up to `FAN_IN` runs, of which it reads only the row groups that meet the range, and
runs beyond that are merged in levels. A URL with very many captures is cut by time and id like any other key.

Cases: a null payload is empty; a null URL is the empty URL; a null time is written as the epoch; a null id comes first and
names no response unless all ids of its payload are null; rows repeated with their id are records each, where the first
of those that share the smallest id and payload are all responses; other columns are not read; an empty table gives no rows.
"""

import gzip
import hashlib
import uuid
from collections.abc import Iterable, Iterator
from datetime import UTC, datetime
from itertools import islice
from urllib.parse import urlsplit

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchloom.llm.shared import filesystem, small_batches, text_of
from matchloom.session import shared_path, staged

LEAST, FAN_IN, RANGE, GROUP = 100, 32, 100_000, 4096
#: Sampled keys that bounds are chosen from, for each range.
SAMPLE = 30

CAPTURE = pa.schema(
    [
        ("url_key", pa.string()), ("time", pa.int64()), ("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
        ("record_type", pa.string()), ("refers_to", pa.int64()), ("archive", pa.string()), ("offset", pa.int64()), ("length", pa.int64()),
    ]
)
COLUMNS = "url_key string, time long, page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, archive string, offset long, length long"


def url_key(url: str) -> str:
    """Host labels from the last to the first, then the path and query, in lower case: pages of a domain are neighbours."""
    try:
        parts = urlsplit(url)
        host = (parts.hostname or "").removeprefix("www.")
    except ValueError:
        return url.lower()
    rest = (parts.path or "/") + (f"?{parts.query}" if parts.query else "")
    return f"{','.join(reversed(host.split('.')))}){rest}".lower()


def record(ident: int | None, url: str, time: int | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """A WARC record. A revisit has no payload; its headers tell the size and digest of what it stands for."""
    stamp = datetime.fromtimestamp(time or 0, UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    target = "".join(c for c in url if c >= " ")
    lines = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:page:{'' if ident is None else ident}>",
        f"WARC-Target-URI: {target}", f"WARC-Date: {stamp}", f"WARC-Payload-Digest: sha256:{digest}", f"X-Payload-Length: {len(payload)}",
    ]
    if revisit:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{'' if refers_to is None else refers_to}>"]
        payload = b""
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n" + payload
    head = "\r\n".join([*lines, "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"])
    return head.encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _page(name: str) -> int | None:
    name = name.removeprefix("<urn:page:").removesuffix(">")
    return int(name) if name else None


def parsed(data: bytes) -> tuple[dict[str, str], bytes]:
    """The headers and the payload of a record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    headers = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in head.decode().split("\r\n")[1:])
    block = rest[: int(headers["Content-Length"])]
    return headers, block.partition(b"\r\n\r\n")[2]


def capture(data: bytes, archive: str, offset: int, length: int) -> dict:
    """The index entry of a record; a response's size and digest come from its payload."""
    headers, payload = parsed(data)
    digest, size = headers["WARC-Payload-Digest"].removeprefix("sha256:"), int(headers["X-Payload-Length"])
    kind = headers["WARC-Type"]
    if kind == "response" and (hashlib.sha256(payload).hexdigest() != digest or len(payload) != size):
        raise ValueError(f"record at {offset} of {archive} is damaged")
    time = int(datetime.strptime(headers["WARC-Date"], "%Y-%m-%dT%H:%M:%SZ").replace(tzinfo=UTC).timestamp())
    return {
        "url_key": url_key(headers["WARC-Target-URI"]), "time": time, "page_id": _page(headers["WARC-Record-ID"]), "payload_bytes": size, "payload_digest": digest,
        "record_type": kind, "refers_to": _page(headers["WARC-Refers-To"]) if kind == "revisit" else None, "archive": archive, "offset": offset, "length": length,
    }


def records_of(stream) -> Iterator[tuple[int, int, bytes]]:
    """offset, length and bytes of the gzip members of an archive, read member by member."""
    import zlib

    at, rest = 0, b""
    while True:
        member, out, used = zlib.decompressobj(31), [], 0
        while not member.eof:
            chunk = rest or stream.read(1 << 20)
            if not chunk:
                break
            rest = b""
            out.append(member.decompress(chunk))
            used += len(chunk) - len(member.unused_data)
            rest = member.unused_data
        if not used:
            return
        yield at, used, b"".join(out)
        at += used


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", time_col: str = "time", payload_col: str = "html") -> DataFrame:
    """Writes the archives and returns their names as a written table."""
    spark = pages.sparkSession
    small_batches(spark)
    payload = text_of(payload_col)
    rows = pages.select(
        F.col(id_col).cast("long").alias("id"), text_of(url_col).alias("url"), F.col(time_col).cast("long").alias("time"), payload.alias("payload"),
        F.sha2(F.encode(payload, "UTF-8"), 256).alias("digest"),
    )
    long_ones = F.octet_length("payload") >= LEAST
    first = rows.where(long_ones).groupBy(F.col("digest").alias("same")).agg(F.min("id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    told = rows.join(first, rows["digest"] == first["same"], "left")
    told = told.select("id", "url", "time", "payload", "digest", "first", (F.col("same").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))).alias("revisit"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = filesystem(folder)
        files.create_dir(root, recursive=True)
        name, out = f"{uuid.uuid4().hex}.warc.gz", None
        for batch in batches:
            for ident, url, time, text, digest, refers, revisit in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                out = out or files.open_output_stream(f"{root}/{name}", compression=None)
                out.write(gzip.compress(record(ident, url, time, text.encode(), digest, refers, revisit), 6, mtime=0))
        if out:
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([name])], names=["archive"])

    return staged(told.mapInArrow(write, "archive string"), "archives")


def _key(row: dict) -> tuple:
    return row["url_key"], row["time"], -1 << 63 if row["page_id"] is None else row["page_id"], row["archive"], row["offset"]


def read_runs(archives: DataFrame, folder: str, runs: str) -> DataFrame:
    """Reads the archives and writes the sorted run of each; returns run, rows, and some of the keys, as a written table."""
    spark = archives.sparkSession
    n = max(1, archives.count())

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = filesystem(folder)
        _, run_root = filesystem(runs)
        files.create_dir(run_root, recursive=True)
        for batch in batches:
            for archive in batch.column(0).to_pylist():
                with files.open_input_stream(f"{root}/{archive}", compression=None) as stream:
                    found = [capture(data, archive, at, length) for at, length, data in records_of(stream)]
                found.sort(key=_key)
                run = f"{uuid.uuid4().hex}.parquet"
                pq.write_table(pa.Table.from_pylist(found, CAPTURE), f"{run_root}/{run}", filesystem=files, row_group_size=GROUP)
                some = found[:: max(1, len(found) // SAMPLE)][:SAMPLE]
                keys = pa.array([[{"url_key": r["url_key"], "time": r["time"], "page_id": r["page_id"] or 0} for r in some]], pa.list_(SAMPLED))
                yield pa.RecordBatch.from_arrays([pa.array([run]), pa.array([len(found)], pa.int64()), keys], names=["run", "rows", "keys"])

    dealt = archives.repartition(n)
    return staged(dealt.mapInArrow(read, "run string, rows long, keys array<struct<url_key:string,time:long,page_id:long>>"), "runs")


SAMPLED = pa.struct([("url_key", pa.string()), ("time", pa.int64()), ("page_id", pa.int64())])


class LoserTree:
    """Merges sorted sources. Inner nodes hold the loser of their match; replacing the winner replays one path."""

    def __init__(self, sources: list[Iterator[tuple[tuple, dict]]]):
        self.sources = sources
        self.heads = [next(s, None) for s in sources]
        self.n = len(sources)
        self.losers = [-1] * max(1, self.n)
        self.winner = self._play(1) if self.n > 1 else 0

    def _beats(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        return y is None or (x is not None and (x[0], a) < (y[0], b))

    def _play(self, node: int) -> int:
        if node >= self.n:
            return node - self.n
        a, b = self._play(2 * node), self._play(2 * node + 1)
        win, lose = (a, b) if self._beats(a, b) else (b, a)
        self.losers[node] = lose
        return win

    def __iter__(self) -> Iterator[dict]:
        while self.n and self.heads[self.winner] is not None:
            win = self.winner
            yield self.heads[win][1]
            self.heads[win] = next(self.sources[win], None)
            node = (win + self.n) // 2
            while node >= 1 and self.n > 1:
                if self._beats(self.losers[node], win):
                    self.losers[node], win = win, self.losers[node]
                node //= 2
            self.winner = win


def _within(files, path: str, low: tuple | None, high: tuple | None) -> Iterator[tuple[tuple, dict]]:
    """The rows of a run from low on and before high. Row groups that end before low or begin after high aren't read."""
    with pq.ParquetFile(path, filesystem=files) as run:
        for i in range(run.num_row_groups):
            bounds = run.metadata.row_group(i).column(0).statistics
            if bounds is not None and bounds.has_min_max and ((low and bounds.max < low[0]) or (high and bounds.min > high[0])):
                continue
            for row in run.read_row_group(i).to_pylist():
                key = _key(row)
                if (low is None or key[:3] >= low) and (high is None or key[:3] < high):
                    yield key, row


def _merged(spark: SparkSession, tasks: list[tuple[int, list[str], tuple | None, tuple | None]], runs: str, final: bool) -> DataFrame:
    """Merges each task's runs within its bounds: into rows with the task's number and their place there, or into new runs."""
    held = spark.sparkContext.broadcast(tasks)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = filesystem(runs)
        for batch in batches:
            for k in batch.column(0).to_pylist():
                part, names, low, high = held.value[k]
                rows = iter(LoserTree([_within(files, f"{root}/{name}", low, high) for name in names]))
                if final:
                    place = 0
                    while block := list(islice(rows, GROUP)):
                        table = pa.Table.from_pylist(block, CAPTURE).combine_chunks().to_batches()[0]
                        where = [pa.array([part] * len(block), pa.int32()), pa.array(range(place, place + len(block)), pa.int64())]
                        yield pa.RecordBatch.from_arrays([*table.columns, *where], names=[*table.schema.names, "part", "place"])
                        place += len(block)
                    continue
                name = f"{uuid.uuid4().hex}.parquet"
                with pq.ParquetWriter(f"{root}/{name}", CAPTURE, filesystem=files) as out:
                    while block := list(islice(rows, GROUP)):
                        out.write_table(pa.Table.from_pylist(block, CAPTURE), row_group_size=GROUP)
                yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([name])], names=["part", "run"])

    each = spark.range(0, len(tasks), 1, max(1, len(tasks)))
    return each.mapInArrow(merge, f"{COLUMNS}, part int, place long" if final else "part int, run string")


def merge_runs(listed: DataFrame, runs: str, fan_in: int = FAN_IN, range_rows: int = RANGE) -> DataFrame:
    """Every capture in global order: by part, then by place in the part. Parts follow each other in the order of keys."""
    spark = listed.sparkSession
    total = listed.agg(F.sum("rows")).first()[0] or 0
    if not total:
        return spark.createDataFrame([], f"{COLUMNS}, part int, place long")
    ranges = max(spark.sparkContext.defaultParallelism, -(-total // range_rows))
    sampled = listed.select(F.explode("keys").alias("k")).select("k.*").orderBy(F.xxhash64("url_key", "time", "page_id")).limit(SAMPLE * ranges)
    keys = sorted({(r["url_key"], r["time"], r["page_id"]) for r in sampled.collect()})  # SAMPLE keys a range at most
    cuts = sorted({keys[len(keys) * i // ranges] for i in range(1, ranges)}) if len(keys) > 1 else []
    bounds = list(zip([None, *cuts], [*cuts, None], strict=True))
    names = [r["run"] for r in listed.select("run").orderBy("run").collect()]  # a name a run
    here: dict[int, list[str]] = {part: names for part in range(len(bounds))}
    while max(len(x) for x in here.values()) > fan_in:
        tasks = [(part, group, *bounds[part]) for part, x in here.items() for group in chunks(x, fan_in)]
        here = {part: [] for part in here}
        for r in staged(_merged(spark, tasks, runs, final=False), "merged").orderBy("part", "run").collect():
            here[r["part"]].append(r["run"])
    return _merged(spark, [(part, x, *bounds[part]) for part, x in here.items()], runs, final=True)


def chunks(items: list[str], size: int) -> Iterable[list[str]]:
    for i in range(0, len(items), size):
        yield items[i : i + size]


def capture_history(pages: DataFrame, **columns: str) -> DataFrame:
    """Writes archives of the pages, reads them back, and returns the merged index of all captures."""
    folder = shared_path(pages.sparkSession, "warc")
    archives = write_archives(pages, f"{folder}/archives", **columns)
    return merge_runs(read_runs(archives, f"{folder}/archives", f"{folder}/runs"), f"{folder}/runs")
