"""Web archives: writing WARC files with revisit records, reading them back, and a merged capture index.

Spark's text writer puts one record per row into the archive files, with the
two line ends that close a record as its line separator. A payload that occurs
before is stored as a revisit record, which names the record that holds it.

Each archive file gives a run of captures sorted by URL key and time. The runs
are dealt into ranges of (URL key, time); in every range a tree of losers merges
the slices of all runs, and the ranges one behind the other are the index, in
which the captures of a URL stand together in the order of time.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from merchlake.llm.common import Rows, kept, rows_of

VERSION = "WARC/1.1"
LEAST_REVISIT = 100
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORDS_PER_FILE = 20_000
ROWS_PER_RANGE = 100_000
CAPTURE = [("page_id", "long"), ("url", "string"), ("captured_at", "string"), ("record_type", "string"), ("refers_to", "long"),
           ("payload_bytes", "long"), ("payload_digest", "string"), ("urlkey", "string"), ("file", "string"), ("offset", "long"),
           ("length", "long")]
_ARROW = {"long": pa.int64(), "string": pa.string()}


def _header(name: str, value: Column) -> Column:
    """A header line, or nothing where the value is NULL; line ends inside a value are escaped."""
    safe = F.replace(F.replace(value, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.coalesce(F.concat(F.lit(f"{name}: "), safe, F.lit("\r\n")), F.lit(""))


def _urn(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("")), F.lit(">"))


def write_archives(
    pages: DataFrame,
    path: str,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    captured_at: Column | None = None,
    least_revisit: int = LEAST_REVISIT,
) -> None:
    """Write one record per row below `path`, in gzip-compressed WARC files.

    The payload is the UTF-8 text of `payload_col` (NULL: empty). Of rows with
    equal payloads of at least `least_revisit` bytes those with the least id are
    response records, the others revisits of that id; NULL ids come last.
    Shorter payloads are always stored. `captured_at` is a time (default:
    2024-01-01 plus the id in seconds). A NULL URL has no header line. Repeated
    rows each give a record. Other columns, whatever their names, are not read.
    """
    payload = F.coalesce(pages[payload_col], F.lit(""))
    moment = F.timestamp_seconds(F.lit(1704067200) + F.coalesce(pages[id_col], F.lit(0))) if captured_at is None else captured_at
    rows = pages.select(
        pages[id_col].cast("long").alias("_id"),
        pages[url_col].alias("_url"),
        payload.alias("_payload"),
        F.octet_length(payload).cast("long").alias("_bytes"),
        F.sha2(payload, 256).alias("_digest"),
        F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("_time"),
    )
    repeated = (
        rows.where(F.col("_bytes") >= least_revisit)
        .groupBy("_digest")
        .agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
        .where("_n > 1")
        .select(F.col("_digest").alias("_again"), "_first")
    )
    joined = rows.join(repeated, F.col("_digest") == F.col("_again"), "left")
    revisit = F.col("_first").isNotNull() & (F.col("_id").isNull() | (F.col("_id") != F.col("_first")))
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("_bytes").cast("string"),
        F.lit("\r\n\r\n"),
    )
    block = F.concat(http, F.when(revisit, F.lit("")).otherwise(F.col("_payload")))
    record = joined.select("*", revisit.alias("_revisit"), block.alias("_block")).select(
        F.concat(
            F.lit(f"{VERSION}\r\n"),
            _header("WARC-Type", F.when(F.col("_revisit"), F.lit("revisit")).otherwise(F.lit("response"))),
            _header("WARC-Record-ID", _urn(F.col("_id"))),
            _header("WARC-Date", F.col("_time")),
            _header("WARC-Target-URI", F.col("_url")),
            _header("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("_digest"))),
            _header("WARC-Profile", F.when(F.col("_revisit"), F.lit(PROFILE))),
            _header("WARC-Refers-To", F.when(F.col("_revisit"), _urn(F.col("_first")))),
            _header("Content-Type", F.lit("application/http; msgtype=response")),
            _header("Content-Length", F.octet_length("_block").cast("string")),
            F.lit("\r\n"),
            F.col("_block"),
        ).alias("value")
    )
    writer = record.write.option("lineSep", "\r\n\r\n").option("compression", "gzip")
    writer.option("maxRecordsPerFile", RECORDS_PER_FILE).text(path)


def url_key(url: str | None) -> str:
    """Host turned round and path: http://www.Example.org:80/A?b becomes org,example)/a?b. No URL gives the empty key."""
    match = re.match(r"[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)([^#]*)", url or "")
    if not match:
        return (url or "").lower()
    host = re.sub(r":\d+$", "", match[1].rpartition("@")[2].lower()).removeprefix("www.")
    return ",".join(reversed(host.split("."))) + ")" + (match[2].lower() or "/")


def _number(urn: str | None) -> int | None:
    digits = urn[len("<urn:page:") : -1] if urn else ""
    return int(digits) if digits else None


def records(data: bytes) -> Iterator[tuple[dict[str, str], bytes, int, int]]:
    """(headers, block, offset, length) of each record of an archive file; offsets count decompressed bytes."""
    stream = io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(data)), 1 << 20)
    offset = 0
    while line := stream.readline():
        if line.strip() == b"":
            offset += len(line)
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no record at {offset}")
        length, headers = len(line), {}
        while (line := stream.readline()) not in (b"\r\n", b""):
            length += len(line)
            name, _, value = line.decode("utf-8").rstrip("\r\n").partition(": ")
            headers[name] = value
        length += len(line)
        block = stream.read(int(headers["Content-Length"]))
        length += len(block)
        yield headers, block, offset, length
        offset += length


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the archives below `path`: page_id, url, captured_at, record_type, refers_to, payload_bytes,
    payload_digest, urlkey, file, offset, length.

    Length and digest of a response are taken from its payload, and a digest that
    differs from the header is an error; those of a revisit from its headers.
    Each file is a run: its rows come sorted by urlkey, captured_at and page_id.
    """
    schema = pa.schema([(name, _ARROW[kind]) for name, kind in CAPTURE])

    def captures(name: str, data: bytes) -> Iterator[tuple]:
        for headers, block, offset, length in records(data):
            http, _, payload = block.partition(b"\r\n\r\n")
            digest, size = headers["WARC-Payload-Digest"].partition(":")[2], len(payload)
            if headers["WARC-Type"] == "revisit":
                size = int(re.search(rb"Content-Length: (\d+)", http)[1])
            elif hashlib.sha256(payload).hexdigest() != digest:
                raise ValueError(f"payload of {headers['WARC-Record-ID']} is damaged")
            url = headers.get("WARC-Target-URI")
            yield (_number(headers["WARC-Record-ID"]), url, headers["WARC-Date"], headers["WARC-Type"],
                   _number(headers.get("WARC-Refers-To")), size, digest, url_key(url), name, offset, length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Rows(schema)
        for batch in batches:
            for name, data in rows_of(batch):
                for row in sorted(captures(name, data), key=_order):
                    yield from out.add(row, 400)
        yield from out.flush()

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path)
    # One file at a time: a batch of Arrow rows would hold many archives at once.
    return files.select("path", "content").mapInArrow(run, ", ".join(f"{n} {t}" for n, t in CAPTURE))


def _order(row: tuple) -> tuple:
    """URL key, time, id (NULL last), file, offset."""
    return row[7], row[2], row[0] is None, row[0] or 0, row[8], row[9]


class LoserTree:
    """Merges sorted runs: inner nodes hold the loser of a match, so the next winner costs one match a level."""

    def __init__(self, runs: list[Iterator[tuple]], key=_order):
        self.runs, self.key = runs, key
        self.size = max(1, len(runs))
        self.head: list[tuple | None] = [None] * self.size
        self.keys: list[tuple] = [(1,)] * self.size
        for i in range(len(runs)):
            self._advance(i)
        self.losers = [-1] * self.size
        self.winner = self._play(1) if self.size > 1 else 0

    def _advance(self, i: int) -> None:
        row = next(self.runs[i], None)
        self.head[i] = row
        # A run that has ended is behind all others.
        self.keys[i] = (1,) if row is None else (0, self.key(row))

    def _play(self, node: int) -> int:
        if node >= self.size:
            return node - self.size
        left, right = self._play(2 * node), self._play(2 * node + 1)
        if self.keys[right] < self.keys[left]:
            left, right = right, left
        self.losers[node] = right
        return left

    def __iter__(self) -> Iterator[tuple]:
        if not self.runs:
            return
        while (row := self.head[self.winner]) is not None:
            yield row
            self._advance(self.winner)
            best, node = self.winner, (self.winner + self.size) // 2
            while node:
                if self.keys[self.losers[node]] < self.keys[best]:
                    best, self.losers[node] = self.losers[node], best
                node //= 2
            self.winner = best


def merged(rows: Iterable[tuple]) -> Iterator[tuple]:
    """Merge rows that come run by run, each run sorted."""
    runs: dict[str, list[tuple]] = {}
    for row in rows:
        runs.setdefault(row[8], []).append(row)
    return iter(LoserTree([iter(run) for run in runs.values()]))


def merge_index(captures: DataFrame) -> DataFrame:
    """The captures in global order, with `position` (from 0) and `capture` (from 1 within the URL key).

    `captures` has the columns of read_archives. The order is URL key, time and
    id, then file and offset. A popular URL key may span many ranges, as the time
    and the id part the ranges as well. An empty index gives an empty result.
    """
    names = [name for name, _ in CAPTURE]
    runs = kept(captures.select(*names))
    order = ["urlkey", "captured_at", F.col("page_id").asc_nulls_last(), "file", "offset"]
    ranges = max(int(captures.sparkSession.conf.get("spark.sql.shuffle.partitions")), runs.count() // ROWS_PER_RANGE + 1)
    # The slices of the runs, one behind the other, each sorted.
    dealt = runs.repartitionByRange(ranges, *order).sortWithinPartitions("file", *order[:3], "offset")
    schema = pa.schema([(name, _ARROW[kind]) for name, kind in CAPTURE] + [("_in_range", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Rows(schema)
        for i, row in enumerate(merged(row for batch in batches for row in rows_of(batch))):
            yield from out.add((*row, i), 400)
        yield from out.flush()

    kind = ", ".join(f"{n} {t}" for n, t in CAPTURE) + ", _in_range long"
    placed = kept(dealt.mapInArrow(run, kind).withColumn("_range", F.spark_partition_id()))
    totals = placed.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(F.col("_range").alias("_of"), F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    numbered = placed.join(offsets, F.col("_range") == F.col("_of")).withColumn("position", F.col("_before") + F.col("_in_range"))
    firsts = numbered.groupBy(F.col("urlkey").alias("_key")).agg(F.min("position").alias("_first"))
    ordered = numbered.join(firsts, F.col("urlkey") == F.col("_key"))
    return ordered.select(*names, "position", (F.col("position") - F.col("_first") + 1).alias("capture"))
