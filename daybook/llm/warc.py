"""WARC archives of web pages and one global index over them.

Writing: every page becomes a WARC/1.1 record.  Of pages with equal payloads the
one with the largest id keeps its payload (``response``), the others are
``revisit`` records that name it and hold HTTP headers only.  Records are packed
into archives of bounded size; Spark's text writer stores each as a gzip file (its
line separator is the blank line that ends a record), so any file system that
Spark writes to will do.

Index: every task that reads archives back sorts its captures by URL key, time
and id: a locally sorted run.  Splitters deal the key space out to tasks, each of
which gets its slice of every run and merges the slices with a loser tree; the
tasks' results one after another are all captures in order.  A URL with very many
captures spans several tasks, as time and id are part of the splitters' key.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from datetime import datetime, timezone
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import shared_path
from .common import chunks, staged, text_of

ARCHIVE_BYTES = 16 << 20
ROWS_PER_TASK = 200_000
END = "\r\n\r\n"
# Fixed value: the profile name of the WARC standard for equal payloads.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# The tables hold no capture times; a page's is its id in seconds after this one.
FIRST_CAPTURE = 1_704_067_200
INDEX = ("run long, place long, url_key string, captured string, page_id string, url string, record_type string, refers_to string, "
         "payload_bytes long, payload_digest string, archive string, offset long, length long")
ORDER = ("url_key", "captured", "page_id")


class BrokenArchive(ValueError):
    """A record's payload does not have the digest or size its headers state."""


def url_key(url: str) -> str:
    """Sort key of a URL: host labels from the right, in lower case, then port,
    path and query; no scheme, no fragment.  "" for an empty URL."""
    rest = url.split("#", 1)[0]
    rest = rest.split("://", 1)[1] if "://" in rest else rest
    cut = min((i for i in map(rest.find, "/?") if i >= 0), default=len(rest))
    host, colon, port = rest[:cut].rsplit("@", 1)[-1].partition(":")
    return ",".join(reversed(host.lower().split("."))) + colon + port + ")" + rest[cut:] if url else ""


def capture_time(page_id) -> str:
    """FIRST_CAPTURE plus the id in seconds, for ids that are whole numbers."""
    seconds = int(page_id) % 1_000_000_000 if page_id is not None and str(page_id).lstrip("-").isdigit() else 0
    return datetime.fromtimestamp(FIRST_CAPTURE + seconds, timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_name(page_id) -> str:
    return "<urn:page:" + ("" if page_id is None else quote(str(page_id), safe="")) + ">"


def page_of(name: str) -> str | None:
    return unquote(name[len("<urn:page:"):-1]) or None


def warc_record(page_id, url: str | None, payload: str, response_id=None, is_revisit: bool = False) -> str:
    """One record without the blank lines that end it."""
    raw = payload.encode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(raw)}{END}"
    fields = [("WARC-Type", "revisit" if is_revisit else "response"), ("WARC-Record-ID", record_name(page_id)),
              ("WARC-Date", capture_time(page_id)), ("WARC-Payload-Digest", "sha1:" + payload_digest(raw))]
    if url:                                     # no line end can stand in a header
        fields.append(("WARC-Target-URI", "".join(quote(c) if c < " " else c for c in url)))
    if is_revisit:
        fields += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", record_name(response_id))]
    length = len(http) + (0 if is_revisit else len(raw))
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(length))]
    return "WARC/1.1\r\n" + "\r\n".join(f"{k}: {v}" for k, v in fields) + END + http + ("" if is_revisit else payload)


def headers(block: bytes) -> dict[str, str]:
    return dict(line.split(": ", 1) for line in block.decode().split("\r\n")[1:])


def read_records(data: bytes) -> Iterator[tuple[int, int, dict[str, str], int, bytes]]:
    """(offset, length, record headers, payload size by its HTTP headers, payload
    or b"" of a revisit) of an archive's records; a ``response`` is compared with
    its digest and size."""
    at, mark = 0, END.encode()
    while at < len(data):
        body = data.index(mark, at) + len(mark)
        fields = headers(data[at:body - len(mark)])
        stop = body + int(fields["Content-Length"])
        payload = data.index(mark, body) + len(mark)
        size = int(headers(data[body:payload - len(mark)])["Content-Length"])
        if fields["WARC-Type"] == "response" and (stop - payload != size
                                                  or fields["WARC-Payload-Digest"] != "sha1:" + payload_digest(data[payload:stop])):
            raise BrokenArchive(fields["WARC-Record-ID"])
        if data[stop:stop + len(mark)] != mark:
            raise BrokenArchive(fields["WARC-Record-ID"])
        yield at, stop - at, fields, size, data[payload:stop]
        at = stop + len(mark)


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                   archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Write a record per row to gzip archives of about ``archive_bytes`` each
    (one record at least) in ``folder``.

    Payloads are told apart by SHA-256.  A null payload is empty, and the empty
    ones are equal; a null id is smaller than any other; rows that repeat a
    payload together with the largest id are all responses.  Payloads that occur
    once need no partner, so only the others' digests are joined; the planner
    broadcasts them while their stored size allows, and else shuffles.
    """
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), text_of(html_col).alias("html"),
                        F.sha2(text_of(html_col).cast("binary"), 256).alias("_sha"))
    shared = staged(rows.groupBy("_sha").agg(F.max("id").alias("response"), F.count(F.lit(1)).alias("_n"))
                    .filter("_n > 1 AND response IS NOT NULL").select(F.col("_sha").alias("_of"), "response"), "warc-shared")
    found = rows.join(shared, F.col("_sha") == F.col("_of"), "left").select(
        "id", "url", "html", "response", (F.col("response").isNotNull() & ~F.col("id").eqNullSafe(F.col("response"))).alias("is_revisit"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for part in chunks(batches, "html", 1 << 20):
            for id_, url, html, response, revisit in zip(*(c.to_pylist() for c in part.columns)):
                held.append(warc_record(id_, url, html, response, revisit))
                size += len(held[-1])
                if size >= archive_bytes:
                    yield pa.RecordBatch.from_pydict({"value": [END.join(held)]})
                    held, size = [], 0
        if held:
            yield pa.RecordBatch.from_pydict({"value": [END.join(held)]})

    (found.mapInArrow(pack, "value string").write.option("lineSep", END).option("compression", "gzip")
     .option("maxRecordsPerFile", 1).text(folder))


def archive_index(spark: SparkSession, folder: str) -> DataFrame:
    """One row per record of the archives in ``folder``, in runs: sorted by URL
    key, time and id within ``run``, with ``place`` in it."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run, names, out = -1, INDEX.replace(" long", "").replace(" string", "").split(", "), []
        for batch in batches:
            for number, path, content in zip(*(batch.column(n) for n in ("run", "path", "content"))):
                run = number.as_py()
                name = path.as_py().rsplit("/", 1)[1]
                for offset, length, fields, size, _ in read_records(zlib.decompress(content.as_buffer(), 31)):
                    url = fields.get("WARC-Target-URI", "")
                    refers = fields.get("WARC-Refers-To")
                    out.append((url_key(url), fields["WARC-Date"], page_of(fields["WARC-Record-ID"]), url, fields["WARC-Type"],
                                page_of(refers) if refers else None, size, fields["WARC-Payload-Digest"][5:], name, offset, length))
        out.sort(key=lambda r: (r[0], r[1], r[2] or "", r[8], r[9]))
        for i in range(0, len(out), 10_000):
            some = out[i:i + 10_000]
            yield pa.RecordBatch.from_arrays([pa.array([run] * len(some), pa.int64()), pa.array(range(i, i + len(some)), pa.int64()),
                                              *(pa.array(c, pa.int64() if n in ("payload_bytes", "offset", "length") else pa.string())
                                                for n, c in zip(names[2:], zip(*some)))], names=names)

    files = spark.read.format("binaryFile").load(folder).select(F.spark_partition_id().cast("long").alias("run"), "path", "content")
    return files.mapInArrow(read, INDEX)


def merge_runs(runs: list[list]) -> Iterator[tuple[int, int]]:
    """(run, place) of all items of sorted lists in ascending order; equal items
    in order of their lists.

    A loser tree: every inner node holds the loser of the match between its two
    subtrees' winners, so after the overall winner moves on only the nodes on its
    path to the root are played again.
    """
    k = len(runs)
    done = [0] * k
    loser = [-1] * max(1, k)

    def before(a: int, b: int) -> bool:
        if done[a] == len(runs[a]) or done[b] == len(runs[b]):
            return done[a] < len(runs[a])
        x, y = runs[a][done[a]], runs[b][done[b]]
        return x < y or (x == y and a < b)

    winner = 0
    for leaf in range(k - 1, -1, -1):               # an empty node holds its first visitor until the other comes
        winner, node = leaf, (leaf + k) // 2
        while node > 0:
            if loser[node] < 0:
                loser[node] = winner
                winner = -1
                break
            if before(loser[node], winner):
                loser[node], winner = winner, loser[node]
            node //= 2
    while k and done[winner] < len(runs[winner]):
        yield winner, done[winner]
        done[winner] += 1
        node = (winner + k) // 2
        while node > 0:
            if before(loser[node], winner):
                loser[node], winner = winner, loser[node]
            node //= 2


def merged_index(runs: DataFrame, tasks: int | None = None) -> DataFrame:
    """The index with every record's ``position`` in the global order of URL key,
    time and id, and ``capture``, its number in its URL's history, both from 1."""
    if tasks is None:
        tasks = max(int(runs.sparkSession.conf.get("spark.sql.shuffle.partitions")), runs.count() // ROWS_PER_TASK + 1)
    dealt = runs.repartitionByRange(tasks, *ORDER).sortWithinPartitions("run", "place").withColumn("part", F.spark_partition_id().cast("long"))
    schema = INDEX + ", part long, _place long, _at long"

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held).combine_chunks()
        keys = list(zip(*([x or "" for x in table.column(c).to_pylist()] for c in ORDER)))
        slices, starts, last = [], [], None
        for i, (run, key) in enumerate(zip(table.column("run").to_pylist(), keys)):
            if run != last:
                slices.append([])
                starts.append(i)
                last = run
            slices[-1].append(key)
        order, at, n, url = [], [], 0, None
        for run, place in merge_runs(slices):
            i = starts[run] + place
            n = n + 1 if keys[i][0] == url else 1
            url = keys[i][0]
            order.append(i)
            at.append(n)
        out = table.take(pa.array(order)).append_column("_place", pa.array(range(1, len(order) + 1), pa.int64()))
        yield from out.append_column("_at", pa.array(at, pa.int64())).combine_chunks().to_batches()

    merged = staged(dealt.mapInArrow(merge, schema), "warc-index")
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    sizes = merged.groupBy("part").agg(F.count(F.lit(1)).alias("_n"))       # one row a task
    starts = sizes.select(F.col("part").alias("_p"), F.coalesce(F.sum("_n").over(before.orderBy("part")), F.lit(0)).alias("_start"))
    ends = merged.groupBy("url_key", "part").agg(F.count(F.lit(1)).alias("_n"))
    begun = (ends.withColumn("_before", F.sum("_n").over(before.partitionBy("url_key").orderBy("part"))).filter("_before IS NOT NULL")
             .select(F.col("url_key").alias("_key"), F.col("part").alias("_part"), "_before"))   # one row a URL and border it crosses
    return (merged.join(F.broadcast(starts), F.col("part") == F.col("_p"))
            .join(begun, (F.col("url_key") == F.col("_key")) & (F.col("part") == F.col("_part")), "left")
            .withColumn("position", F.col("_start") + F.col("_place"))
            .withColumn("capture", F.col("_at") + F.coalesce("_before", F.lit(0)))
            .drop("_at", "_place", "_p", "_start", "_key", "_part", "_before", "place", "run", "part"))


def capture_report(pages: DataFrame, folder: str | None = None, id_col: str = "page_id", url_col: str = "url",
                   html_col: str = "html") -> DataFrame:
    """Write the archives, read them back and merge their index: one row per
    page with id, payload_bytes, payload_digest, record_type, refers_to, url_key,
    position and capture.

    Extra columns are not read; a page without a URL sorts first; an empty table
    gives an empty result.  ``folder``: where the archives go (default: below
    ``spark.checkpoint.dir``, until the session ends).
    """
    spark = pages.sparkSession
    folder = folder or shared_path(spark, f"daybook-warc-{uuid.uuid4().hex}")
    write_archives(pages, folder, id_col, url_col, html_col)
    kind = pages.schema[id_col].dataType
    index = merged_index(staged(archive_index(spark, folder), "warc-runs"))
    return index.select(F.col("page_id").cast(kind).alias(id_col), "payload_bytes", "payload_digest", "record_type",
                        F.col("refers_to").cast(kind).alias("refers_to"), "url_key", "position", "capture")

