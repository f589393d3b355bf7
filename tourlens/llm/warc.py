"""WARC archives of captures, and their global index by external merge.

Pages are written as WARC/1.1 records, gzip-compressed, in files whose records are sorted by URL key and capture time:
locally sorted runs. Of equal payloads the one with the smallest id is a response, the others are revisits that refer to it.
The archives are then read back, record by record, digests checked; the index entries are dealt out by ranges of URL key and time, and in each
range a loser tree merges the runs. The result is in global order: the capture history of each URL, one after the other.

The text writer makes the files: a record's end, two line breaks, is its line separator, so records are exactly as the
format wants them, and any store that Spark writes to will do. Files hold at most `RECORDS` records.

Capture times are `EPOCH` plus the id in seconds, modulo `SPAN` so that any id gives a legal date: pages carry none of their own.

Defined cases: a null payload is an empty one, and empty payloads equal each other. A record without an id is a response, its
time the epoch. Rows that repeat an id and payload are all responses; entries that tie in key, time and id are ordered by file and place. A null url has
the empty key and no target header; line breaks in a url become spaces. Only the named columns are read. An empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import io
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tourlens.llm.common import written
from tourlens.sources import workspace

EPOCH = "2024-01-01 00:00:00"
#: A hundred years in seconds.
SPAN = 3_155_760_000
#: Records of a file at most.
RECORDS = 5000
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = "\r\n\r\n"


def base32(hexadecimal: Column) -> Column:
    """40 hexadecimal digits as 32 of base 32: eight groups of five digits, four letters each."""
    groups = [F.lpad(F.conv(F.substring(hexadecimal, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*groups), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def url_key(url: Column) -> Column:
    """Host labels from the last to the first, then the path: captures of a site sort together."""
    parts = r"^(?:[A-Za-z][A-Za-z0-9+.-]*://)?(?:[^/?#@]*@)?([^/?#:]*)(?::[0-9]*)?([^#]*)"
    host = F.regexp_replace(F.lower(F.regexp_extract(url, parts, 1)), r"^www[0-9]*\.", "")
    path = F.regexp_extract(url, parts, 2)
    reached = F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), F.when(path == "", "/").otherwise(F.lower(path)))
    return F.coalesce(reached, F.lit(""))


def records(pages: DataFrame, key: str, url: str, payload: str, least: int) -> DataFrame:
    """A record per row: url_key, captured_at, id and the record's text, not yet sorted."""
    rows = pages.select(
        F.col(key).alias("id"),
        F.regexp_replace(F.col(url), r"[\r\n]+", " ").alias("url"),
        F.coalesce(F.col(payload).cast("string"), F.lit("")).alias("payload"),
    )
    rows = rows.withColumn("digest", base32(F.sha1(F.col("payload").cast("binary")))).withColumn("size", F.octet_length("payload"))
    firsts = rows.where(F.col("size") >= least).groupBy("digest").agg(F.min("id").alias("first"), F.count("*").alias("n"))
    firsts = written(firsts.where("n > 1 and first is not null").select("digest", "first"), "warc-firsts")
    rows = rows.join(firsts, "digest", "left")
    revisit = F.col("id").isNotNull() & F.col("first").isNotNull() & (F.col("id") != F.col("first")) & (F.col("size") >= least)
    time = F.to_timestamp(F.lit(EPOCH)) + F.make_dt_interval(secs=F.pmod(F.coalesce(F.col("id"), F.lit(0)).cast("long"), F.lit(SPAN)).cast("decimal(18,6)"))
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("size").cast("string"), F.lit(END)
    )
    rows = rows.withColumn("revisit", F.coalesce(revisit, F.lit(False))).withColumn("captured_at", F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    block = F.concat(http, F.when(F.col("revisit"), "").otherwise(F.col("payload")))
    name = F.concat(F.lit("<urn:page:"), F.coalesce(F.col("id").cast("string"), F.lit("none")), F.lit(">"))
    head = F.concat_ws(
        "\r\n",
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), F.when(F.col("revisit"), "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: "), name),
        F.concat(F.lit("WARC-Date: "), F.col("captured_at")),
        F.concat(F.lit("WARC-Target-URI: "), F.col("url")),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("digest")),
        F.when(F.col("revisit"), F.concat(F.lit(f"WARC-Profile: {PROFILE}\r\nWARC-Refers-To: <urn:page:"), F.col("first").cast("string"), F.lit(">"))),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")),
    )
    return rows.select(url_key(F.col("url")).alias("url_key"), "captured_at", "id", F.concat(head, F.lit(END), block).alias("record"))


def write_archives(pages: DataFrame, path: str, key: str = "page_id", url: str = "url", payload: str = "html", least: int = 0) -> None:
    """Files of records below `path`, each sorted by URL key, time and id."""
    runs = records(pages, key, url, payload, least).sortWithinPartitions("url_key", "captured_at", "id")
    options = {"lineSep": END, "compression": "gzip", "maxRecordsPerFile": RECORDS}
    runs.select("record").write.options(**options).text(path)


def _entries(content: bytes) -> Iterator[tuple]:
    """url, time, id, offset, payload bytes, digest, type and reference of each record of a file."""
    stream = io.BufferedReader(_Inflated(content), 1 << 20)
    offset = 0
    while line := stream.readline():
        assert line == b"WARC/1.1\r\n", line
        size, fields = len(line), {}
        while (line := stream.readline()) != b"\r\n":
            size += len(line)
            name, _, value = line.decode().rstrip("\r\n").partition(": ")
            fields[name] = value
        block = stream.read(int(fields["Content-Length"]))
        assert stream.read(4) == END.encode()
        head, _, payload = block.partition(END.encode())
        length = int(head.rpartition(b"Content-Length: ")[2])
        digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
        kind = fields["WARC-Type"]
        if kind == "response":
            assert length == len(payload) and digest == base64.b32encode(hashlib.sha1(payload).digest()).decode(), fields
        own, first = (fields.get(x, "<urn:page:none>")[len("<urn:page:") : -1] for x in ("WARC-Record-ID", "WARC-Refers-To"))
        yield (
            fields.get("WARC-Target-URI"), fields["WARC-Date"], None if own == "none" else int(own), offset,
            length, digest, kind, None if first == "none" else int(first),
        )
        offset += size + 2 + len(block) + 4


class _Inflated(io.RawIOBase):
    """The uncompressed bytes of a gzip file of one or several members, a piece at a time."""

    def __init__(self, content: bytes):
        self._rest, self._inflate = content, zlib.decompressobj(31)

    def readable(self) -> bool:
        return True

    def readinto(self, buffer) -> int:
        while self._rest or not self._inflate.eof:
            if self._inflate.eof:
                self._inflate = zlib.decompressobj(31)
            data = self._inflate.decompress(self._rest, len(buffer))
            self._rest = self._inflate.unused_data if self._inflate.eof else self._inflate.unconsumed_tail
            if data:
                buffer[: len(data)] = data
                return len(data)
            if not self._rest:
                break
        return 0


ENTRY = "url string, captured_at string, page_id long, offset long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """An index entry per record of the archives: ENTRY, url_key and the file's name."""

    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in ENTRY.split(", ")] + ["file"]
        kinds = [pa.int64() if " long" in x else pa.string() for x in ENTRY.split(", ")] + [pa.string()]
        for batch in batches:
            for file, content in zip(batch.column("path"), batch.column("content"), strict=True):
                rows = list(_entries(content.as_py()))  # at most RECORDS
                columns = list(zip(*rows, strict=True)) if rows else [()] * (len(names) - 1)
                columns.append([file.as_py().rpartition("/")[2]] * len(rows))
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")
    return files.mapInArrow(opened, f"{ENTRY}, file string").withColumn("url_key", url_key(F.col("url")))


class LoserTree:
    """Merges sorted runs: each inner node keeps the loser of its match, the winner goes up."""

    def __init__(self, runs: list[Iterator]):
        self._runs = runs
        self._heads = [next(r, None) for r in runs]
        self._size = max(len(runs), 1)
        self._losers = [-1] * self._size
        for i in range(len(runs)):
            self._play(i)

    def _before(self, a: int, b: int) -> bool:
        x, y = self._heads[a], self._heads[b]
        return y is None if x is None or y is None else x <= y if a < b else x < y

    def _play(self, winner: int) -> None:
        node = (winner + self._size) // 2
        while node > 0:
            other = self._losers[node]
            if other < 0:  # the first to come waits for its match
                self._losers[node] = winner
                return
            if not self._wins(winner, other):
                self._losers[node], winner = winner, other
            node //= 2
        self._losers[0] = winner

    def _wins(self, a: int, b: int) -> bool:
        if self._heads[a] is None:
            return False
        return self._heads[b] is None or self._before(a, b)

    def __iter__(self) -> Iterator:
        if not self._runs:
            return
        while (best := self._heads[winner := self._losers[0]]) is not None:
            yield best
            self._heads[winner] = next(self._runs[winner], None)
            self._play(winner)


def merged_index(entries: DataFrame) -> DataFrame:
    """The entries in global order of URL key, time and id: each range merges its pieces of the sorted runs."""
    order = ["url_key", "captured_at", "page_id", "file", "offset"]
    ranges = entries.repartitionByRange(*order)

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [b for b in batches if b.num_rows]
        if not parts:
            return
        table = pa.Table.from_batches(parts)
        keys = list(zip(*(table.column(c).to_pylist() for c in order), strict=True))
        keys = [(u, t, -1 if i is None else i, f, o, n) for n, (u, t, i, f, o) in enumerate(keys)]
        # Runs arrive in pieces, one after the other; where the order falls, the next begins.
        cuts = [0, *(n for n in range(1, len(keys)) if keys[n] < keys[n - 1]), len(keys)]
        runs = [iter(keys[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]
        yield from table.take([k[-1] for k in LoserTree(runs)]).combine_chunks().to_batches()

    return ranges.mapInArrow(merged, entries.schema)


def archived(pages: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html", least: int = 0) -> DataFrame:
    """Writes the pages to archives in the shared folder, reads them back and returns the merged index."""
    spark = pages.sparkSession
    path = workspace.new_folder(spark, "warc")
    write_archives(pages, path, key, url, payload, least)
    return merged_index(written(read_archives(spark, path), "warc-index"))
