"""WARC archives of pages and a merged index of their captures.

`write_archives` writes one WARC/1.1 record per page with Spark's text sink,
whose line separator is the blank lines that end a record, so each part file is an
uncompressed archive and the commit protocol makes repeated tasks harmless. Of
equal payloads the smallest page_id becomes a response, the others revisits
without payload that refer to it.

`capture_index` reads the archives back by their Content-Length, sorts each file's
captures by (url key, time, page_id) into a run, deals the runs out by ranges of
that order and merges them in each range with a loser tree: partition by
partition the result is the capture history of all URLs in order. There are as many ranges as
keep one at about RANGE_CAPTURES captures, whatever their number; ranges cut the history of a URL, too.

Defined results: a null html is an empty payload; a null url has no
WARC-Target-URI and the empty url key; a null page_id is written as `null` and
counts as larger than any other; repeated rows of the smallest page_id of a
payload are all responses; files hold at most FILE_RECORDS records of up to
LONG_BYTES, longer ones a file of their own; an empty table has no captures.
Other columns are not archived.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelmart.llm.common import parallelism, stage

FILE_RECORDS = 1024
LONG_BYTES = 1 << 18
# Captures a task merges: some 50 MB.
RANGE_CAPTURES = 100_000
# Pages carry no time of capture: one second each from here, by page_id.
FIRST_CAPTURE = 1_704_067_200
CAPTURE_SPAN = 315_360_000
# The alphabet of base32 and the revisit profile of the WARC standard.
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_END = "\r\n\r\n"
DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"


def base32(hex_digest: Column) -> Column:
    """Base32 of a 40-digit hexadecimal string: eight digits for every forty bits."""
    part = lambda k: F.lpad(F.conv(F.substring(hex_digest, 10 * k + 1, 10), 16, 32), 8, "0")
    return F.translate(F.upper(F.concat(*(part(k) for k in range(4)))), DIGITS, BASE32)


def _lines(*lines: Column | str) -> Column:
    return F.concat(*(F.concat(line if isinstance(line, Column) else F.lit(line), F.lit("\r\n")) for line in lines))


def records(pages: DataFrame, firsts: DataFrame) -> DataFrame:
    """One column `record`: the text of each page's WARC record without the blank lines that end it."""
    payload = F.coalesce(F.col("html"), F.lit(""))
    base = pages.select(F.col("page_id").cast("long"), "url", payload.alias("payload"))
    base = base.withColumn("digest", F.sha1(F.col("payload").cast("binary")))
    marked = base.join(firsts, "digest", "left")
    size = F.octet_length("payload").cast("string")
    name = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("null")), F.lit(">"))
    is_copy = F.coalesce(F.col("first") < F.coalesce(F.col("page_id"), F.lit((1 << 63) - 1)), F.lit(False))
    seconds = F.lit(FIRST_CAPTURE) + F.pmod(F.coalesce("page_id", F.lit(0)), F.lit(CAPTURE_SPAN))
    date = F.date_format(F.to_utc_timestamp(F.timestamp_seconds(seconds), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    uri = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    http = _lines("HTTP/1.1 200 OK", "Content-Type: text/html; charset=utf-8", F.concat(F.lit("Content-Length: "), size), "")
    block = F.when(F.col("is_copy"), F.col("http")).otherwise(F.concat("http", "payload"))
    head = _lines(
        "WARC/1.1",
        F.concat(F.lit("WARC-Type: "), F.when(F.col("is_copy"), "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: "), name(F.col("page_id"))),
        F.concat(F.lit("WARC-Date: "), date),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), base32(F.col("digest"))),
        "Content-Type: application/http; msgtype=response",
        F.concat(F.lit("Content-Length: "), F.octet_length("block").cast("string")),
    )
    more = F.concat(
        F.coalesce(_lines(F.concat(F.lit("WARC-Target-URI: "), uri)), F.lit("")),
        F.when(
            F.col("is_copy"),
            _lines(F.lit(f"WARC-Profile: {PROFILE}"), F.concat(F.lit("WARC-Refers-To: "), name(F.col("first")))),
        ).otherwise(""),
    )
    made = marked.withColumn("is_copy", is_copy).withColumn("http", http).withColumn("block", block)
    return made.select(F.concat(head, more, F.lit("\r\n"), "block").alias("record"), F.octet_length("payload").alias("size"))


def write_archives(pages: DataFrame, folder: str) -> None:
    """Archives of all pages (page_id, url, html) below `folder`."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    slim = stage(pages.select(F.col("page_id").cast("long"), F.sha1(payload).alias("digest"), F.octet_length(payload).alias("size")), "payloads")
    firsts = slim.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    # Stored first, so that Spark knows its size: the pages are shuffled only if copies are many.
    made = records(pages, stage(firsts, "first-copies"))
    short = made.where(F.col("size") <= LONG_BYTES).select("record")
    short.write.option("lineSep", RECORD_END).option("maxRecordsPerFile", FILE_RECORDS).text(f"{folder}/archives")
    if slim.where(F.col("size") > LONG_BYTES).head(1):
        long = made.where(F.col("size") > LONG_BYTES).select("record")
        long.write.mode("append").option("lineSep", RECORD_END).option("maxRecordsPerFile", 1).text(f"{folder}/archives")


CAPTURES = (
    "url_key string, captured string, page_id long, record_type string, refers_to long,"
    " payload_bytes long, payload_digest string, file string, offset long, length long"
)
NAMES = [column.split()[0] for column in CAPTURES.replace("\n", "").split(",")]


def url_key(url: str | None) -> str:
    """Sort-friendly form: host parts reversed, then the path; scheme and `www` dropped, lower case."""
    if not url:
        return ""
    rest = url.split("://", 1)[-1]
    cut = min((i for i in map(rest.find, "/?#") if i >= 0), default=len(rest))
    host = rest[:cut].rpartition("@")[2].lower()
    host = host.removesuffix(":80").removesuffix(":443").removeprefix("www.")
    return ",".join(reversed(host.split("."))) + ")" + (rest[cut:].lower() or "/")


def parse(archive: bytes) -> Iterator[dict]:
    """The captures of an archive, by the lengths its records state."""
    at = 0
    while at < len(archive):
        head_end = archive.index(b"\r\n\r\n", at)
        lines = archive[at:head_end].decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record at offset {at}")
        head = dict(line.split(": ", 1) for line in lines[1:])
        block_at = head_end + 4
        block_end = block_at + int(head["Content-Length"])
        http_end = archive.index(b"\r\n\r\n", block_at)
        http = archive[block_at:http_end].decode().split("\r\n")
        stated = int(dict(line.split(": ", 1) for line in http[1:])["Content-Length"])
        payload = memoryview(archive)[http_end + 4 : block_end]
        digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
        if head["WARC-Type"] == "response" and (len(payload), digest) != (stated, base64.b32encode(hashlib.sha1(payload).digest()).decode()):
            raise ValueError(f"the record at offset {at} does not match its length or digest")
        number = lambda name: int(v) if (v := head.get(name, "null>").rpartition(":")[2][:-1]) != "null" else None
        end = block_end + len(RECORD_END)
        yield {
            "url_key": url_key(head.get("WARC-Target-URI")),
            "captured": head["WARC-Date"],
            "page_id": number("WARC-Record-ID"),
            "record_type": head["WARC-Type"],
            "refers_to": number("WARC-Refers-To"),
            "payload_bytes": stated,
            "payload_digest": digest,
            "offset": at,
            "length": end - at,
        }
        at = end


def capture_order(row: dict) -> tuple:
    page_id = row["page_id"]
    return row["url_key"], row["captured"], page_id is None, page_id or 0, row["file"], row["offset"]


class LoserTree:
    """Merge sorted lists: each inner node keeps the loser of its last match, so a step replays one path."""

    def __init__(self, runs: list[list[tuple]]):
        self.runs, self.k = runs, len(runs)
        self.at = [0] * self.k
        self.losers = [-1] * max(self.k, 1)
        self.winner = self._play(1) if self.k > 1 else 0

    def _head(self, run: int) -> tuple:
        # An exhausted run loses against every other.
        return (0, self.runs[run][self.at[run]]) if self.at[run] < len(self.runs[run]) else (1, run)

    def _play(self, node: int) -> int:
        if node >= self.k:
            return node - self.k
        a, b = self._play(2 * node), self._play(2 * node + 1)
        winner, loser = (a, b) if self._head(a) <= self._head(b) else (b, a)
        self.losers[node] = loser
        return winner

    def __iter__(self) -> Iterator[tuple]:
        if not self.k:
            return
        while self.at[self.winner] < len(self.runs[self.winner]):
            run = self.winner
            yield self.runs[run][self.at[run]]
            self.at[run] += 1
            best, head, node = run, self._head(run), (run + self.k) // 2
            while node >= 1:
                other = self._head(self.losers[node])
                if other < head:
                    best, self.losers[node] = self.losers[node], best
                    head = other
                node //= 2
            self.winner = best


def runs(spark: SparkSession, folder: str) -> DataFrame:
    """The captures of each archive, sorted within the file: `file` is the run, `seq` the place in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                file = path.rpartition("/")[2]
                rows = sorted(({**row, "file": file} for row in parse(content.as_py())), key=capture_order)
                yield pa.RecordBatch.from_pylist([{**row, "seq": i} for i, row in enumerate(rows)], schema=schema)

    schema = pa.schema([*_capture_schema(), pa.field("seq", pa.int64())])
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{folder}/archives")
    return files.select("path", "content").mapInArrow(run, f"{CAPTURES}, seq long")


def _capture_schema() -> list[pa.Field]:
    kinds = {"string": pa.string(), "long": pa.int64()}
    return [pa.field(*(lambda n, t: (n, kinds[t]))(*column.split())) for column in CAPTURES.split(",")]


def capture_index(spark: SparkSession, folder: str) -> DataFrame:
    """All captures in the order of (url_key, captured, page_id), range by range."""
    local = stage(runs(spark, folder), "index-runs")

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides, file = [], None
        for batch in batches:
            for row in batch.to_pylist():
                if row["file"] != file:
                    sides.append([])
                    file = row["file"]
                sides[-1].append((capture_order(row), row))
        held = []
        for _, row in LoserTree(sides):
            held.append(row)
            if len(held) == 10_000:
                yield pa.RecordBatch.from_pylist(held, schema=schema)
                held = []
        if held:
            yield pa.RecordBatch.from_pylist(held, schema=schema)

    schema = pa.schema(_capture_schema())
    order = ("url_key", "captured", F.col("page_id").asc_nulls_last(), "file", "offset")
    ranges = max(parallelism(spark), -(-local.count() // RANGE_CAPTURES))
    dealt = local.repartitionByRange(ranges, *order).sortWithinPartitions("file", "seq")
    return dealt.mapInArrow(merge, CAPTURES)
