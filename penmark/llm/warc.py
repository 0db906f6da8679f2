"""WARC archives as a chunked record table.

A payload travels as rows (record, chunk number, bytes), each with the SHA-1 of
the payload up to its end, never longer than ``chunk_bytes``.  A payload of one
chunk is one WARC record; a longer one is a segmented record: the first chunk
is the response, the others are ``continuation`` records with
``WARC-Segment-Number``.  Archives are written by Spark's text writer, one
record per row, and read back with what stands between two records as the row
separator.  A payload that holds that separator is
cut inside it, into two segments.

Defined results: a null payload is empty; a null id is written as an empty
field and read back as null; rows that repeat (equal id and payload) are
records of their own with equal answers; of equal payloads of ``least`` bytes
or more, every row with the largest id is a response; extra columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from penmark.session import scratch_path

CHUNK_BYTES = 64 << 10
REVISIT_FROM = 1000
VERSION = b"WARC/1.1\r\n"
END = "\r\n\r\n"
#: What stands between two records: the end of one and the version line of the next.
BETWEEN = END + "WARC/1.1\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def decide(records: DataFrame, least: int = REVISIT_FROM) -> DataFrame:
    """(page_id, url, payload, sha1, refers_to): ``refers_to`` is the largest
    id with the same payload where that is another row's, else null."""
    r = (records.withColumn("__pm_n", F.length("payload")).withColumn("sha1", F.sha1("payload"))
         .withColumn("__pm_x", F.xxhash64("payload")))
    # only payloads that repeat are in the other side; SHA-1, a second hash and the length decide equality
    top = (r.where(F.col("__pm_n") >= least).groupBy("sha1", "__pm_x", "__pm_n")
           .agg(F.max("page_id").alias("__pm_top"), F.count(F.lit(1)).alias("__pm_c"))
           .where("__pm_c > 1").drop("__pm_c"))
    return (r.join(top, ["sha1", "__pm_x", "__pm_n"], "left")
            .withColumn("refers_to", F.when(~F.col("page_id").eqNullSafe(F.col("__pm_top")), F.col("__pm_top")))
            .select("page_id", "url", "payload", "sha1", "refers_to"))


def cuts(data: bytes, chunk_bytes: int) -> list[int]:
    """Ends of the chunks: every ``chunk_bytes``, and inside any separator."""
    ends = set(range(chunk_bytes, len(data), chunk_bytes)) | {len(data)}
    at = data.find(VERSION)
    while at >= 0:                      # also at the payload's start, where the header's end stands before it
        ends.add(at + 4)
        at = data.find(VERSION, at + 1)
    return sorted(ends)


def record_id(page_id, sha1: str) -> str:
    h = hashlib.md5(f"{page_id}|{sha1}".encode()).hexdigest()
    return f"<urn:uuid:{h[:8]}-{h[8:12]}-{h[12:16]}-{h[16:20]}-{h[20:]}>"


def to_records(table: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """One row ``value`` per WARC record, without the two line ends after it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out, size = [], 0
            for i in range(b.num_rows):
                page, url, payload, sha1, refers, row = (b.column(c)[i].as_py() for c in range(6))
                base = {"WARC-Record-ID": record_id(page, sha1), "WARC-Date": "1970-01-01T00:00:00Z",
                        "WARC-Target-URI": " ".join((url or "").split()), "X-Page-Id": "" if page is None else page,
                        "X-Row": row, "WARC-Payload-Digest": f"sha1:{sha1}", "X-Payload-Length": len(payload)}
                if refers is not None:
                    out.append(_record(base | {"WARC-Type": "revisit", "WARC-Profile": _PROFILE, "X-Refers-To": refers,
                                               "WARC-Refers-To": record_id(refers, sha1)}, b""))
                    continue
                view, at, running = memoryview(payload), 0, hashlib.sha1()
                ends = cuts(payload, chunk_bytes)
                for n, end in enumerate(ends, 1):
                    running.update(view[at:end])
                    head = base | {"WARC-Type": "response" if n == 1 else "continuation",
                                   "WARC-Segment-Number": n, "X-Segments": len(ends),
                                   "X-Running-Digest": f"sha1:{running.hexdigest()}"}
                    if n > 1:
                        head["WARC-Segment-Origin-ID"] = head["WARC-Record-ID"]
                        head["WARC-Record-ID"] = record_id(f"{page}#{n}", sha1)
                    out.append(_record(head, view[at:end]))
                    at, size = end, size + end - at
                    if size >= 8 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])
                        out, size = [], 0
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])

    return (table.withColumn("__pm_row", F.monotonically_increasing_id())
            .select("page_id", "url", "payload", "sha1", "refers_to", "__pm_row").mapInArrow(run, "value binary"))


def _record(head: dict, block) -> bytes:
    lines = "".join(f"{k}: {v}\r\n" for k, v in (head | {"Content-Length": len(block)}).items())
    return b"".join((VERSION, lines.encode("utf-8", "replace"), b"\r\n", block))


def write(records: DataFrame, path: str) -> str:
    """Records as gzip text parts under ``path``; each part is a WARC file."""
    # the writer puts the bytes of a string as they are
    records.select(F.col("value").cast("string").alias("value")).write.option("lineSep", END).text(path, compression="gzip")
    return path


def read(spark: SparkSession, path: str) -> DataFrame:
    """(page_id text, row, segment, segments, type, refers_to, payload_bytes,
    digest, block) of each WARC record in the archives."""
    raw = spark.read.option("lineSep", BETWEEN).text(path).where(F.length("value") > 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in _READ.split(", ")]
        for b in batches:
            rows = []
            for v in b.column(0):
                data = v.as_buffer().to_pybytes().removeprefix(VERSION)     # the first of a file
                at = data.index(b"\r\n\r\n")
                head = dict(x.split(": ", 1) for x in data[:at].decode().split("\r\n"))
                size = int(head["Content-Length"])
                block, rest = data[at + 4:at + 4 + size], data[at + 4 + size:]
                if len(block) != size or rest not in (b"", END.encode()):   # the last of a file keeps its end
                    raise ValueError(f"record {head['WARC-Record-ID']} has not {size} bytes")
                rows.append((head["X-Page-Id"] or None, int(head["X-Row"]), int(head.get("WARC-Segment-Number", 1)),
                             int(head.get("X-Segments", 1)), head["WARC-Type"], head.get("X-Refers-To"),
                             int(head["X-Payload-Length"]), head["WARC-Payload-Digest"][5:], block))
            cols = list(zip(*rows)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, _ARROW)], names=names)

    return raw.select(F.col("value").cast("binary").alias("value")).mapInArrow(run, _READ)


_READ = ("page_id string, row long, segment int, segments int, type string, refers_to string, "
         "payload_bytes long, digest string, block binary")
_ARROW = [pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]


_DONE = "page_id string, payload_bytes long, payload_digest string, record_type string, refers_to string"
_DONE_ARROW = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string()]
_DONE_NAMES = [f.split()[0] for f in _DONE.split(", ")]


def digests(records: DataFrame) -> DataFrame:
    """One row per payload: its bytes and SHA-1 from the stream of its chunks.

    Records of one segment are digested where they are read and go on without
    their bytes; the chunks of longer ones are sorted by (row, segment) and run
    through one digest, which holds a chunk at a time.  The digest must equal
    the one in the header.
    """
    names = [f.split()[0] for f in _READ.split(", ")]

    def check(size: int, digest: str, r: dict) -> None:
        if (size, digest) != (r["payload_bytes"], r["digest"]):
            raise ValueError(f"payload of page {r['page_id']} differs from its digest")

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = b.to_pylist()
            for r in rows:
                if r["segments"] == 1:
                    if r["type"] != "revisit":
                        check(len(r["block"]), hashlib.sha1(r["block"]).hexdigest(), r)
                    r["block"] = None
            yield pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], t) for n, t in zip(names, _ARROW)], names=names)

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sha, size = None, None, 0
        for b in batches:
            out = []
            for r in b.to_pylist():
                if r["segments"] > 1:
                    if r["segment"] == 1:
                        now, sha, size = r["row"], hashlib.sha1(), 0
                    if r["row"] != now:
                        raise ValueError(f"segments of row {r['row']} are not whole")
                    sha.update(r["block"])
                    size += len(r["block"])
                    if r["segment"] < r["segments"]:
                        continue
                    check(size, sha.hexdigest(), r)
                kind = "revisit" if r["type"] == "revisit" else "response"
                out.append((r["page_id"], r["payload_bytes"], r["digest"], kind, r["refers_to"]))
            cols = list(zip(*out)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, _DONE_ARROW)], names=_DONE_NAMES)

    return (records.mapInArrow(whole, _READ).repartition("row").sortWithinPartitions("row", "segment")
            .mapInArrow(stream, _DONE))


def archive(pages: DataFrame, path: str | None = None, id_col: str = "page_id", url_col: str = "url",
            html_col: str = "html", chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Write ``pages`` as WARC archives and read every record back."""
    spark = pages.sparkSession
    table = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"),
                         F.encode(F.coalesce(F.col(html_col), F.lit("")), "UTF-8").alias("payload"))
    kind = table.schema["page_id"].dataType
    path = write(to_records(decide(table), chunk_bytes), path or scratch_path(spark, "warc"))
    got = digests(read(spark, path))
    return got.select(F.col("page_id").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                      F.col("refers_to").cast(kind).alias("refers_to"))
