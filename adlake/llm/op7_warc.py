"""WARC archives as a chunked record table.

Writing: each record is one or more rows, a row for every chunk of the payload
(first chunk in a `response` record, the others in `continuation` records with
WARC-Segment-Number, as the format's segmentation says).  Rows are written by
Spark's text sink with the record separator CR LF CR LF between them, so the
files are plain concatenations of WARC records, gzip-compressed as a whole.

Reading: Spark's text source streams each archive through one task (gzip files
are not split), cut at CR LF CR LF; the parser puts pieces together again by
Content-Length, so separators inside payloads do no harm.  It yields rows
(record id, chunk number) with the running length and SHA-1 and never holds
more than one chunk.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adlake.llm.tables import shared_path, written

SEPARATOR = "\r\n\r\n"
CHUNK_CHARS = 1 << 18  # at most 1 MB of UTF-8
MIN_REVISIT_BYTES = 1000

CHUNKS = pa.schema([
    ("record_id", pa.string()), ("chunk_no", pa.int32()), ("record_type", pa.string()), ("target_uri", pa.string()),
    ("page_id", pa.int64()), ("refers_to", pa.int64()), ("declared_digest", pa.string()), ("declared_bytes", pa.int64()),
    ("chunk_bytes", pa.int64()), ("running_bytes", pa.int64()), ("running_sha1", pa.string()),
    ("last", pa.bool_()), ("chunk", pa.binary())])


def planned_records(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """(page_id, url, html, payload_bytes, payload_digest, record_type,
    refers_to).  Of equal payloads of at least `min_bytes` bytes the one with
    the largest page_id is the response.  Rows that share that page_id are all
    responses; a null page_id is below every other one.  The largest id is a
    partial aggregate of (digest, length, id), and the payloads are joined to
    it, so a payload that a third of the pages share is no single group."""
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    rows = rows.withColumn("payload_digest", F.sha1(F.col("html").cast("binary"))).withColumn(
        "payload_bytes", F.octet_length("html").cast("bigint"))
    keeper = written(  # from a table, so that the join can split a hot payload
        rows.where(F.col("payload_bytes") >= min_bytes).groupBy("payload_digest", "payload_bytes")
        .agg(F.max("page_id").alias("keeper"), F.count("*").alias("copies")).where("copies > 1"), "warc-keepers")
    out = rows.join(keeper, ["payload_digest", "payload_bytes"], "left")
    revisit = F.col("copies").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("keeper"))
    return out.select(
        "page_id", "url", "html", "payload_bytes", "payload_digest",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("keeper")).alias("refers_to"))


def _uuid(*parts: Column) -> Column:
    h = F.md5(F.to_json(F.array(*[p.cast("string") for p in parts])))
    return F.concat_ws("-", *[h.substr(a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])


def _clean(c: Column) -> Column:
    return F.regexp_replace(c, r"[\r\n]", "%0A")


def record_rows(records: DataFrame, chunk_chars: int = CHUNK_CHARS, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """A text row for each record and chunk: headers, separator, payload bytes."""
    rid = F.concat(F.lit("urn:uuid:"), _uuid(F.col("page_id"), F.col("url"), F.col("payload_digest")))
    parts = F.when(F.col("record_type") == "revisit", F.array(F.lit(""))).when(
        F.length("html") <= chunk_chars, F.array("html")).otherwise(
        F.regexp_extract_all("html", F.lit(f"(?s).{{1,{chunk_chars}}}"), F.lit(0)))
    rows = records.withColumn("record_id", rid).withColumn("parts", parts).withColumn("n_parts", F.size("parts"))
    rows = rows.drop("html").select("*", F.posexplode("parts").alias("no", "part")).drop("parts")

    def line(name: str, value: Column) -> Column:  # null: no such line
        return F.concat(F.lit(f"{name}: "), value.cast("string"))

    first = F.col("no") == 0
    segmented = F.col("n_parts") > 1
    own_id = F.when(first, F.col("record_id")).otherwise(
        F.concat(F.lit("urn:uuid:"), _uuid(F.col("record_id"), F.col("no"))))
    head = F.concat_ws(
        "\r\n", F.lit("WARC/1.1"),
        line("WARC-Type", F.when(first, F.col("record_type")).otherwise(F.lit("continuation"))),
        line("WARC-Record-ID", F.concat(F.lit("<"), own_id, F.lit(">"))),
        line("WARC-Date", F.lit(date)),
        line("WARC-Target-URI", F.when(first, _clean(F.col("url")))),
        line("WARC-Payload-Digest", F.when(first, F.concat(F.lit("sha1:"), F.col("payload_digest")))),
        line("WARC-Block-Digest", F.concat(F.lit("sha1:"), F.sha1(F.col("part").cast("binary")))),
        line("WARC-Segment-Number", F.when(segmented, F.col("no") + 1)),
        line("WARC-Segment-Origin-ID", F.when(~first, F.concat(F.lit("<"), F.col("record_id"), F.lit(">")))),
        line("WARC-Segment-Total-Length", F.when(segmented & (F.col("no") == F.col("n_parts") - 1), F.col("payload_bytes"))),
        line("WARC-Profile", F.when(F.col("record_type") == "revisit",
                                    F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))),
        line("X-Page-ID", F.when(first, F.col("page_id"))),
        line("X-Refers-To-Page-ID", F.when(first, F.col("refers_to"))),
        line("X-Payload-Length", F.when(first, F.col("payload_bytes"))),
        line("Content-Type", F.lit("text/html; charset=utf-8")),
        line("Content-Length", F.octet_length("part")))
    return rows.select(F.concat(head, F.lit(SEPARATOR), F.col("part")).alias("value"))


def write_archives(pages: DataFrame, path: str, min_bytes: int = MIN_REVISIT_BYTES,
                   chunk_chars: int = CHUNK_CHARS) -> None:
    """Write `pages` as gzip WARC files below `path`, one per task.  The chunks
    of a record are neighbours in one file."""
    rows = record_rows(planned_records(pages, min_bytes), chunk_chars)
    rows.write.option("lineSep", SEPARATOR).option("compression", "gzip").text(path)


class _Parser:
    """Rebuilds records from separator-cut pieces of a byte stream; holds one
    chunk and the hash of the open record."""

    def __init__(self) -> None:
        self.head: dict[str, str] | None = None
        self.parts: list[bytes] = []
        self.have = self.need = 0
        self.record: dict | None = None

    def feed(self, piece: bytes) -> Iterator[dict]:
        """One piece and the separator after it."""
        if self.head is None:
            text = piece.lstrip(b"\r\n")
            if not text:
                return
            self.head = dict(x.split(": ", 1) for x in text.decode("utf-8").split("\r\n")[1:])
            self.need, self.have, self.parts = int(self.head["Content-Length"]), 0, []
            return
        if self.parts:
            self.parts.append(b"\r\n\r\n")
            self.have += 4
        self.parts.append(piece)
        self.have += len(piece)
        if self.have + 4 < self.need:
            return
        block = b"".join(self.parts)
        # What follows the block is the rest of this piece, or the separator after it.
        while len(block) < self.need:
            block += b"\r\n\r\n"
        rest = block[self.need :]
        yield self.chunk(block[: self.need])
        self.head = None
        if rest.strip(b"\r\n"):
            yield from self.feed(rest)

    def chunk(self, block: bytes) -> dict:
        head = self.head or {}
        if "WARC-Segment-Origin-ID" not in head:
            page, refers, size = (head.get(k) for k in ("X-Page-ID", "X-Refers-To-Page-ID", "X-Payload-Length"))
            self.record = {
                "record_id": head["WARC-Record-ID"].strip("<>"), "record_type": head["WARC-Type"],
                "target_uri": head.get("WARC-Target-URI"), "page_id": None if page is None else int(page),
                "refers_to": None if refers is None else int(refers),
                "declared_digest": head["WARC-Payload-Digest"].removeprefix("sha1:"),
                "declared_bytes": int(size or 0), "no": 0, "bytes": 0, "sha1": hashlib.sha1()}
        record = self.record
        if record is None or head.get("WARC-Segment-Origin-ID", f"<{record['record_id']}>").strip("<>") != record["record_id"]:
            raise ValueError("a continuation record without its first segment")
        if head["WARC-Block-Digest"].removeprefix("sha1:") != hashlib.sha1(block).hexdigest():
            raise ValueError(f"damaged block in {record['record_id']}")
        record["sha1"].update(block)
        record["bytes"] += len(block)
        record["no"] += 1
        segmented = "WARC-Segment-Number" in head
        return {k: record[k] for k in ("record_id", "record_type", "target_uri", "page_id", "refers_to", "declared_digest", "declared_bytes")} | {
            "chunk_no": record["no"], "chunk_bytes": len(block), "running_bytes": record["bytes"],
            "running_sha1": record["sha1"].hexdigest(), "last": not segmented or "WARC-Segment-Total-Length" in head, "chunk": block}


def _read(with_chunks: bool):
    schema = CHUNKS if with_chunks else pa.schema([f for f in CHUNKS if f.name != "chunk"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser = _Parser()
        for batch in batches:
            rows: list[dict] = []
            held = 0
            for piece in batch.column(0):
                for row in parser.feed(piece.as_buffer().to_pybytes()):
                    held += row["chunk_bytes"]
                    rows.append(row if with_chunks else {k: v for k, v in row.items() if k != "chunk"})
                if held > 4 << 20:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)
                    rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return read


def read_archives(spark: SparkSession, path: str, with_chunks: bool = True) -> DataFrame:
    """The chunk table of the archives below `path`: a row for each record id
    and chunk number with the running length and digest; `last` marks a
    record's last chunk.  The order of rows inside a file is kept by one task
    per file, and a file ends with a whole record."""
    kinds = ("record_id string, chunk_no int, record_type string, target_uri string, page_id long, refers_to long, "
             "declared_digest string, declared_bytes long, chunk_bytes long, running_bytes long, running_sha1 string, last boolean")
    pieces = spark.read.option("lineSep", SEPARATOR).text(path).select(F.col("value").cast("binary").alias("value"))
    return pieces.mapInArrow(_read(with_chunks), kinds + (", chunk binary" if with_chunks else ""))


def round_trip(pages: DataFrame, path: str | None = None) -> DataFrame:
    """Write `pages`, read the archives back and report each record.

    Lengths and digests of responses are those of the bytes read back; a
    revisit has no block and reports what its headers declare.  Null html is an
    empty payload; repeated rows are records of their own; an empty table gives
    empty archives and no rows."""
    spark = pages.sparkSession
    path = path or shared_path(spark, "warc")
    write_archives(pages, path)
    ends = read_archives(spark, path, with_chunks=False).where("last")
    revisit = F.col("record_type") == "revisit"
    return ends.select(
        "page_id", F.when(revisit, F.col("declared_bytes")).otherwise(F.col("running_bytes")).alias("payload_bytes"),
        F.when(revisit, F.col("declared_digest")).otherwise(F.col("running_sha1")).alias("payload_digest"),
        "record_type", "refers_to", F.col("chunk_no").alias("n_chunks"))
