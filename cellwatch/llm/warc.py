"""WARC archives as locally sorted capture runs, merged into one ordered index.

Writing: each task sorts its captures by (URL key, time, page) and writes them as WARC files, one
run each; only digests and ids are shuffled to tell responses from revisits, and each page once
more to where its decision is. Records end in two line breaks, which is what separates the lines
of Spark's text writer, so archives go to any store Spark can write.

Reading: the archives are read back and parsed by their length fields, payload digests are
checked, and each record becomes an index entry that names its run and its place in it. Entries
are dealt by ranges of (URL key, time, page), so a host of any size is cut, and in each range a
loser tree merges the pieces of the runs: the entries of a run arrive in their own order and only
the heads of the runs are compared. Ranges are ordered among themselves, so the whole is too.

Defined results: null html is an empty payload; a null URL has an empty key; rows of the same page
and payload are alike: if they have the largest id, all of them are responses; a null page_id is
smaller than all others; other columns are dropped; an empty table gives an empty one.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from datetime import datetime, timedelta, timezone

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellwatch.sources.scratch import materialize, scratch_path

END = b"\r\n\r\n"
#: Captures have no time of their own in the table: page n was taken n seconds after this.
EPOCH = datetime(2024, 1, 1, tzinfo=timezone.utc)
SPAN = 50 * 365 * 86400
NO_PAGE = -2**63
RUN_RECORDS, INDEX_ROWS = 20_000, 50_000
ENTRY = ["page_id", "url", "ts", "run", "seq", "offset", "payload_bytes", "payload_digest", "record_type", "refers_to"]
ENTRY_TYPES = [pa.int64(), pa.string(), pa.int64(), pa.string(), *[pa.int64()] * 3, pa.string(), pa.string(), pa.int64()]
ENTRY_DDL = ("page_id bigint, url string, ts bigint, run string, seq bigint, offset bigint, payload_bytes bigint, "
             "payload_digest string, record_type string, refers_to bigint")


def url_key(url: Column) -> Column:
    """Host parts from the right, then path and query, in lower case: captures of a host and its
    subdomains lie together. Scheme, ``www.``, port 80/443 and fragment do not count."""
    u = F.regexp_replace(F.lower(F.coalesce(url, F.lit(""))), r"^[a-z][a-z0-9+.-]*://|#.*$", "")
    host = F.regexp_replace(F.substring_index(F.substring_index(u, "/", 1), "?", 1), r"^www\d*\.|:(80|443)$", "")
    rest = F.regexp_replace(u, r"^[^/?]*", "")
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"),
                    F.when(rest == "", "/").otherwise(rest))


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def decisions(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """(id2, sha2, leader) of (page_id, sha, size): the largest page of each payload, null where
    the payload is too small to be shared. Distinct, so repeated rows do not multiply."""
    lead = pages.where(F.col("size") >= least_bytes).groupBy("sha", "size").agg(
        F.max(F.coalesce("page_id", F.lit(NO_PAGE).cast("long"))).alias("leader"))
    return pages.select("page_id", "sha", "size").distinct().join(lead, ["sha", "size"], "left").select(
        F.col("page_id").alias("id2"), F.col("sha").alias("sha2"), "leader")


def _record(page: int | None, url: str, payload: str, sha: str, leader: int | None) -> str:
    number = NO_PAGE if page is None else page
    when = (EPOCH + timedelta(seconds=max(0, number) % SPAN)).strftime("%Y-%m-%dT%H:%M:%SZ")
    revisit = leader is not None and leader != number
    body = payload.encode()
    head = [f"WARC/1.1\r\nWARC-Type: {'revisit' if revisit else 'response'}",
            f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{number} {url}')}>",
            f"WARC-Target-URI: {url}", f"WARC-Date: {when}",
            f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(sha)).decode()}",
            f"Page-ID: {'' if page is None else page}", f"Payload-Length: {len(body)}"]
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"Refers-To-Page: {leader}"]
        payload, body = "", b""
    head += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {len(body)}", "", ""]
    return "\r\n".join(head) + payload


def write_runs(pages: DataFrame, path: str, least_bytes: int = 0) -> None:
    """Archives of (page_id, url, html) under ``path``: gzip files, each sorted in itself."""
    html = F.coalesce("html", F.lit(""))
    rows = pages.select("page_id", "url", html.alias("html"), F.sha1(html.cast("binary")).alias("sha"),
                        F.octet_length(html).alias("size"))
    found = decisions(rows, least_bytes)
    known = rows.join(found, rows["page_id"].eqNullSafe(found["id2"]) & (rows["sha"] == found["sha2"]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                columns = [c.to_pylist() for c in batch.slice(at, 500).columns]
                yield pa.RecordBatch.from_arrays([pa.array(
                    [_record(p, " ".join((u or "").split()), h, s, x) for p, u, h, s, x in zip(*columns)])], ["value"])

    known.sortWithinPartitions(url_key(F.col("url")), F.coalesce("page_id", F.lit(NO_PAGE).cast("long"))).select(
        "page_id", "url", "html", "sha", "leader").mapInArrow(run, "value string").write.option(
            "lineSep", END.decode()).option("compression", "gzip").option("maxRecordsPerFile", RUN_RECORDS).text(path)


def _inflated(blob: bytes) -> Iterator[bytes]:
    """Plain bytes of one or more gzip members, in pieces."""
    view, at = memoryview(blob), 0
    unzip = zlib.decompressobj(31)
    while at < len(view):
        piece = view[at:at + (1 << 18)]
        at += len(piece)
        yield unzip.decompress(piece)
        if unzip.eof:
            at -= len(unzip.unused_data)
            unzip = zlib.decompressobj(31)


def records(blob: bytes) -> Iterator[tuple[int, dict, bytes]]:
    """(offset, header, payload) of each record of an archive, by its length fields."""
    pieces, held, gone = _inflated(blob), bytearray(), 0

    def need(n: int) -> bool:
        while len(held) < n:
            more = next(pieces, None)
            if more is None:
                return False
            held.extend(more)
        return True

    while need(len(END)):
        end = held.find(END)
        while end < 0:
            if not need(len(held) + 1):
                raise ValueError("a record without an end of its header")
            end = held.find(END)
        head = dict(line.split(": ", 1) for line in held[:end].decode().split("\r\n")[1:])
        start, size = end + len(END), int(head["Content-Length"])
        if not need(start + size + len(END)):
            raise ValueError("a record shorter than its length field")
        if held[start + size:start + size + len(END)] != END:
            raise ValueError("a record that does not end where its length field says")
        yield gone, head, bytes(held[start:start + size])
        gone += start + size + len(END)
        del held[:start + size + len(END)]


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """The index entries of all archives under ``path``. Payloads are held against their digests."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, blob in zip(batch.column(0), batch.column(1)):
                rows = []
                for seq, (offset, head, payload) in enumerate(records(blob.as_py())):
                    revisit = head["WARC-Type"] == "revisit"
                    sha = head["WARC-Payload-Digest"].removeprefix("sha1:")
                    if not revisit and digest(payload) != sha:
                        raise ValueError(f"{name}: the payload at {offset} does not have its digest")
                    when = datetime.strptime(head["WARC-Date"], "%Y-%m-%dT%H:%M:%SZ").replace(tzinfo=timezone.utc)
                    leader = int(head["Refers-To-Page"]) if revisit else None
                    rows.append((int(head["Page-ID"]) if head["Page-ID"] else None, head["WARC-Target-URI"],
                                 int(when.timestamp()), name.as_py(), seq, offset, int(head["Payload-Length"]), sha,
                                 head["WARC-Type"], leader))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows), ENTRY_TYPES)], ENTRY)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("path", "content")
    entries = files.mapInArrow(run, ENTRY_DDL)
    return entries.withColumn("urlkey", url_key(F.col("url"))).withColumn(
        "run", F.regexp_extract("run", "[^/]*$", 0)).drop("url")


class LoserTree:
    """Heads of k sorted runs; inner nodes hold the losers, so a step replays one path."""

    def __init__(self, runs: list[Iterator]):
        self.runs, self.k = runs, len(runs)
        self.heads = [next(r, None) for r in runs]
        self.losers = [-1] * self.k
        for i in range(self.k):
            self._play(i)

    def _beats(self, a: int, b: int) -> bool:
        if self.heads[b] is None:
            return True
        return self.heads[a] is not None and self.heads[a] <= self.heads[b]

    def _play(self, winner: int) -> None:
        """Up from a leaf: the better one goes on, the other stays; an empty node takes the first."""
        node = (winner + self.k) // 2
        while node:
            if self.losers[node] < 0:
                self.losers[node] = winner
                return
            if not self._beats(winner, self.losers[node]):
                winner, self.losers[node] = self.losers[node], winner
            node //= 2
        self.losers[0] = winner

    def __iter__(self) -> Iterator:
        while self.k and self.heads[top := self.losers[0]] is not None:
            yield self.heads[top]
            self.heads[top] = next(self.runs[top], None)
            self._play(top)


def merged(entries: DataFrame) -> DataFrame:
    """Entries in capture order: ``piece`` numbers the ranges, ``place`` the entries of a range."""
    ranges = max(1, -(-entries.count() // INDEX_ROWS))
    order = [F.col("urlkey"), F.col("ts"), F.coalesce("page_id", F.lit(NO_PAGE).cast("long"))]
    dealt = entries.repartitionByRange(ranges, *order).sortWithinPartitions("run", "seq")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches)) if (batches := list(batches)) else None
        if table is None or not table.num_rows:
            return
        keys = list(zip(*(table.column(c).to_pylist() for c in ("urlkey", "ts", "page_id"))))
        heads = [(u, t, NO_PAGE if p is None else p, i) for i, (u, t, p) in enumerate(keys)]
        names = table.column("run").to_pylist()
        cuts = [0, *(i for i in range(1, len(names)) if names[i] != names[i - 1]), len(names)]
        took = [x[-1] for x in LoserTree([iter(heads[a:b]) for a, b in zip(cuts, cuts[1:])])]
        piece = TaskContext.get().partitionId()
        table = table.take(pa.array(took)).append_column("piece", pa.array([piece] * len(took), pa.int32()))
        yield from table.append_column("place", pa.array(range(len(took)), pa.int64())).combine_chunks().to_batches()

    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in dealt.schema.fields)
    return dealt.mapInArrow(run, f"{ddl}, piece int, place bigint")


def round_trip(pages: DataFrame) -> DataFrame:
    """The digest of the contract: writes archives, reads them back, merges their index."""
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write_runs(pages, path)
    index = merged(materialize(read_runs(spark, path), "warc-index"))
    return index.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to",
                        "urlkey", "ts", "run", "seq", "offset", "piece", "place")
