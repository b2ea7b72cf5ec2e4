"""Web archives written and read by Spark, with payloads as chunk rows.

A payload is cut where it is read; from there on a record is a run of rows
(record, chunk number, bytes) and nothing holds more than a chunk of it. A long
payload becomes a segmented WARC record: a first segment and ``continuation``
records. Spark's text writer writes a segment as one line, so archives get to any
file system that Spark can write, under its commit protocol. They are read as lines
too, whatever these hold; the reader goes by ``Content-Length``.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..tables.files import scratch_dir
from .shared import python_ready, stored

CHUNK = 1 << 20
# Shorter payloads are stored again instead of referred to.
REVISIT_FROM = 100
# Lines of an archive in an Arrow batch, at most.
LINES = 2048
END = b"\r\n\r\n"
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"

_IDS = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # the URL name space


def _url(pages: DataFrame) -> Column:
    url = pages["url"] if "url" in pages.columns else F.lit(None)
    return url.cast("string").alias("url")


def payload_rows(pages: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """page_id, url, row, digest, size, number, last, data: the chunks of each
    page's html in UTF-8; a null or empty one has one empty chunk."""
    whole = pages.select(
        pages["page_id"].alias("page_id"),
        _url(pages),
        F.monotonically_increasing_id().alias("row"),
        F.encode(F.coalesce(pages["html"].cast("string"), F.lit("")), "UTF-8").alias("payload"),
    ).withColumns({"digest": F.sha2("payload", 256), "size": F.octet_length("payload").cast("long")})
    chunks = F.greatest(F.lit(1), F.ceil(F.col("size") / chunk)).cast("int")
    numbered = whole.withColumn("chunks", chunks).withColumn(
        "number", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))
    )
    return numbered.select(
        "page_id",
        "url",
        "row",
        "digest",
        "size",
        "number",
        (F.col("number") == F.col("chunks") - 1).alias("last"),
        F.substring("payload", F.col("number") * chunk + 1, F.lit(chunk)).alias("data"),
    )


def revisits(pages: DataFrame, least: int = REVISIT_FROM) -> DataFrame:
    """page_id, digest, first and first_url: pages whose payload, of ``least`` bytes or more,
    equals that of a page with a smaller id. Payloads stay where they are."""
    payload = F.encode(F.coalesce(pages["html"].cast("string"), F.lit("")), "UTF-8")
    narrow = pages.select(
        pages["page_id"].alias("page_id"),
        _url(pages),
        F.sha2(payload, 256).alias("digest"),
        F.octet_length(payload).alias("size"),
    )
    narrow = stored(narrow.where(F.col("size") >= least).drop("size"))
    least_page = F.min(F.struct("page_id", "url")).alias("least")
    named = narrow.where(F.col("page_id").isNotNull())
    groups = named.groupBy("digest").agg(least_page, F.count("*").alias("n")).where("n > 1")
    groups = groups.select(
        "digest", F.col("least.page_id").alias("first"), F.col("least.url").alias("first_url")
    )
    return named.drop("url").join(groups, "digest").where("page_id > first").distinct()


def _header(fields: list[tuple[str, object]]) -> bytes:
    lines = [VERSION] + [f"{k}: {v}".encode() for k, v in fields if v is not None]
    return b"\r\n".join(lines) + END


def _address(url: str | None, page_id) -> str:
    if not url:
        return f"urn:x-page:{page_id}"
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


def _segments(batches: Iterator) -> Iterator:
    """One row per WARC record or segment, without the last byte, a newline."""
    import pyarrow as pa

    for batch in batches:
        out = []
        for r in batch.to_pylist():
            page_id, digest, number = r["page_id"], r["digest"], r["number"]
            own = uuid.uuid5(_IDS, f"{page_id} {digest} {r['row']}").urn
            first = r["first"]
            if first is not None and number:
                continue  # a revisit has no payload
            http = b""
            if number == 0:
                http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {r['size']}".encode() + END
            body = http if first is not None else http + r["data"]
            segmented = first is None and not (number == 0 and r["last"])
            kind = "revisit" if first is not None else "continuation" if number else "response"
            fields = [
                ("WARC-Type", kind),
                ("WARC-Record-ID", f"<{own if not number else uuid.uuid5(_IDS, f'{own} {number}').urn}>"),
                ("WARC-Date", DATE),
                ("WARC-Target-URI", _address(r["url"], page_id)),
                ("Content-Type", "application/http;msgtype=response" if not number else None),
                ("WARC-Payload-Digest", f"sha256:{digest}"),
                ("WARC-Block-Digest", f"sha256:{hashlib.sha256(body).hexdigest()}"),
                ("WARC-Profile", PROFILE if first is not None else None),
                ("WARC-Refers-To-Target-URI", _address(r["first_url"], first) if first is not None else None),
                ("WARC-Refers-To-Date", DATE if first is not None else None),
                ("WARC-Segment-Number", number + 1 if segmented else None),
                ("WARC-Segment-Origin-ID", f"<{own}>" if number else None),
                ("WARC-Segment-Total-Length", r["size"] if segmented and r["last"] else None),
                ("Page-ID", page_id),
                ("Refers-To-Page-ID", first),
                ("Content-Length", len(body)),
            ]
            out.append(_header(fields) + body + END[:-1])
        yield pa.RecordBatch.from_pydict({"value": pa.array(out, pa.binary())})


def write_archives(pages: DataFrame, path: str, chunk: int = CHUNK, least: int = REVISIT_FROM) -> None:
    """Write a record per row of pages (page_id, url, html) to gzipped archives in a
    new folder. Of equal payloads of ``least`` bytes or more the smallest page_id's
    is a response and the others revisit it.

    Rows that repeat page_id and payload are records of one kind; a row without a
    page_id is a response; an empty table gives no record. The payloads move once,
    by page, so copies of one payload do not meet in one task.
    """
    python_ready(pages.sparkSession)
    again = revisits(pages, least).select(
        F.col("page_id").alias("r_page"), F.col("digest").alias("r_digest"), "first", "first_url"
    )
    rows = payload_rows(pages, chunk)
    same = (F.col("page_id") == F.col("r_page")) & (F.col("digest") == F.col("r_digest"))
    joined = rows.join(again, same, "left").drop("r_page", "r_digest")
    # The chunks of a row come from one task and have one key, so they are together.
    runs = joined.sortWithinPartitions("page_id", "digest", "row", "number")
    lines = runs.mapInArrow(_segments, "value binary").select(F.col("value").cast("string"))
    lines.write.option("compression", "gzip").option("lineSep", "\n").text(path)


class ArchiveReader:
    """Takes an archive's lines, as split at newlines, and gives chunk rows. It
    holds one chunk, what the lines brought beyond it, and a running digest."""

    def __init__(self, chunk: int = CHUNK) -> None:
        self.chunk = chunk
        self.buffer = bytearray()
        self.need = None  # bytes of the block still to come; None: a header comes next
        self.field: dict[str, str] = {}
        self.record: dict | None = None

    def feed(self, line: bytes) -> Iterator[tuple]:
        self.buffer += line
        self.buffer += b"\n"
        while True:
            if self.need is None:
                end = self.buffer.find(END)
                if end < 0:
                    return
                self._open(bytes(self.buffer[:end]))
                del self.buffer[: end + 4]
            if self.need > self.chunk and len(self.buffer) >= self.chunk:
                yield from self._take(self.chunk, False)
            elif self.need <= self.chunk and len(self.buffer) >= self.need + 4:
                yield from self._take(self.need, True)
                del self.buffer[:4]
                self.need = None
                if not self.buffer:
                    return
            else:
                return

    def _open(self, header: bytes) -> None:
        lines = header.decode("utf-8").split("\r\n")
        if lines[0] != VERSION.decode():
            raise ValueError(f"Not a WARC record: {lines[0][:80]!r}")
        field = dict(line.split(": ", 1) for line in lines[1:])
        self.field, self.need = field, int(field["Content-Length"])
        if field["WARC-Type"] != "continuation":
            self.record = {
                "id": field["WARC-Record-ID"],
                "number": 0,
                "bytes": 0,
                "hash": hashlib.sha256(),
                "type": field["WARC-Type"],
                "head": True,
            }

    def _take(self, n: int, ends: bool) -> Iterator[tuple]:
        data, own = bytes(self.buffer[:n]), self.record
        del self.buffer[:n]
        self.need -= n
        if own["head"]:  # the HTTP header before the payload
            data, own["head"] = data[data.index(END) + 4 :], False
        own["hash"].update(data)
        own["bytes"] += len(data)
        field = self.field
        last = ends and ("WARC-Segment-Number" not in field or "WARC-Segment-Total-Length" in field)
        known = own["type"] == "revisit"
        yield (
            own["id"],
            own["number"],
            last,
            int(field["Page-ID"]) if "Page-ID" in field else None,
            field.get("WARC-Target-URI"),
            own["type"],
            int(field["Refers-To-Page-ID"]) if "Refers-To-Page-ID" in field else None,
            own["bytes"],
            field["WARC-Payload-Digest"].partition(":")[2] if known else own["hash"].copy().hexdigest(),
            data,
        )
        own["number"] += 1


def read_chunks(spark: SparkSession, path: str, with_data: bool = True, chunk: int = CHUNK) -> DataFrame:
    """Archives as chunk rows: record_id, chunk, last, page_id, target_uri,
    record_type, refers_to, payload_bytes and payload_digest (both of the payload up
    to and with this chunk; a revisit has the digest of what it refers to) and
    data. An archive is read in its order by one task, a chunk at a time."""
    # Lines are short, as a rule; the bytes of a batch are bounded besides.
    python_ready(spark, LINES)
    fields = [
        T.StructField("record_id", T.StringType()),
        T.StructField("chunk", T.IntegerType()),
        T.StructField("last", T.BooleanType()),
        T.StructField("page_id", T.LongType()),
        T.StructField("target_uri", T.StringType()),
        T.StructField("record_type", T.StringType()),
        T.StructField("refers_to", T.LongType()),
        T.StructField("payload_bytes", T.LongType()),
        T.StructField("payload_digest", T.StringType()),
    ]
    if with_data:
        fields.append(T.StructField("data", T.BinaryType()))
    width = len(fields)

    def parsed(batches: Iterator) -> Iterator:
        import pyarrow as pa

        kinds = [pa.string(), pa.int32(), pa.bool_(), pa.int64(), pa.string(), pa.string()]
        kinds += [pa.int64(), pa.int64(), pa.string(), pa.binary()]
        names = [f.name for f in fields]
        reader, file = ArchiveReader(chunk), None
        for batch in batches:
            out, held = [], 0
            for line, source in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                if source != file:
                    reader, file = ArchiveReader(chunk), source
                for row in reader.feed(line.as_py()):
                    out.append(row[:width])
                    held += len(row[-1]) if with_data else 1
                    if held > 8 * chunk:
                        yield _batch(out, names, kinds)
                        out, held = [], 0
            if out:
                yield _batch(out, names, kinds)

    def _batch(rows, names, kinds):
        import pyarrow as pa

        columns = zip(*rows, strict=True)
        arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=False)]
        return pa.RecordBatch.from_arrays(arrays, names=names)

    # Gzipped files are not split, so a task sees whole archives.
    lines = spark.read.option("lineSep", "\n").text(path)
    lines = lines.select(F.col("value").cast("binary"), F.col("_metadata.file_path").alias("file"))
    return lines.mapInArrow(parsed, T.StructType(fields))


def records(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the archives: page_id, payload_bytes, payload_digest,
    record_type, refers_to and target_uri, for revisits of the payload they refer
    to, whose length is looked up in its response."""
    rows = read_chunks(spark, path, with_data=False).where("last")
    rows = stored(rows.drop("record_id", "chunk", "last"))
    origin = rows.where("record_type = 'response'").select(
        F.col("page_id").alias("o_page"),
        F.col("payload_digest").alias("o_digest"),
        F.col("payload_bytes").alias("o_bytes"),
    )
    same = (F.col("refers_to") == F.col("o_page")) & (F.col("payload_digest") == F.col("o_digest"))
    met = rows.join(origin.distinct(), same, "left")
    size = F.when(F.col("record_type") == "revisit", F.col("o_bytes")).otherwise(F.col("payload_bytes"))
    return met.select(
        "page_id",
        size.alias("payload_bytes"),
        "payload_digest",
        "record_type",
        "refers_to",
        "target_uri",
    )


def round_trip(pages: DataFrame) -> DataFrame:
    """Write pages to archives in the shared folder and read the records back."""
    spark = pages.sparkSession
    path = f"{scratch_dir(spark)}/archives"
    write_archives(pages, path)
    return records(spark, path)
