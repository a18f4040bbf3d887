"""WARC archives: written by Spark's text sink, read by a Python data source.

Writing is SQL only: a record is header lines, a blank line and the payload, and CR LF CR LF, the record separator, is the
sink's line separator. Equal payloads have one response, the record with the largest id; the others are revisits that refer to
it and carry no payload.

Reading plans a partition for each run of files of about ``split`` bytes, from the file list that the driver takes through
Spark's file system. Predicates on record type and on header columns are pushed down. Headers are parsed first; a record that
the predicates refuse, and a payload that was not asked for, is skipped by its length and never decoded.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualNullSafe, EqualTo, In, InputPartition, IsNotNull, IsNull
from pyspark.sql.types import StructType

from chargeplan.llm.common import base32

#: Columns and the header that each comes from.
HEADERS = {
    "warc_type": "warc-type",
    "record_id": "warc-record-id",
    "target_uri": "warc-target-uri",
    "date": "warc-date",
    "payload_digest": "warc-payload-digest",
    "refers_to": "warc-refers-to",
    "content_type": "content-type",
    "page_id": "x-page-id",
    "payload_length": "x-payload-length",
}
SCHEMA = ", ".join(f"{c} {'long' if c in ('page_id', 'payload_length') else 'string'}" for c in HEADERS) + ", content_length long, payload binary"


def write_warc(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least_revisit: int = 0, date: str = "2024-01-01T00:00:00Z", compression: str = "gzip") -> None:
    """A record for each row of pages. least_revisit: payloads of fewer bytes are always responses.

    A null payload is empty, a null url has no target header, a null id has no id header and its record is never referred to.
    Repeated ids: the rows with the largest id of a payload are all responses. Control characters and spaces of a url are
    written as %20. Other columns are not read.
    """
    page = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"), F.coalesce(F.col(payload_col).cast("string"), F.lit("")).alias("payload"))
    page = page.withColumn("bytes", F.octet_length("payload")).withColumn("digest", F.sha1(F.encode("payload", "UTF-8")))
    newest = page.groupBy("digest").agg(F.max("id").alias("newest"))
    # the payloads stay where they are; only ids and digests are dealt by digest
    marks = page.select("id", "digest").join(newest, "digest").where("id < newest").select("id", "digest", "newest").distinct()
    page = page.join(marks, ["id", "digest"], "left").withColumn("newest", F.when(F.col("bytes") >= least_revisit, F.col("newest")))
    line = lambda name, value: F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))).otherwise("")
    urn = lambda c: F.concat(F.lit("<urn:page:"), c.cast("string"), F.lit(">"))
    revisit = F.col("newest").isNotNull()
    record = F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", urn(F.col("id"))),
        line("WARC-Date", F.lit(date)),
        line("WARC-Target-URI", F.regexp_replace("url", "[\\x00-\\x20\\x7f]", "%20")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), base32(F.upper("digest")))),
        line("WARC-Refers-To", urn(F.col("newest"))),
        line("WARC-Profile", F.when(revisit, "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        line("X-Page-Id", F.col("id").cast("string")),
        line("X-Payload-Length", F.col("bytes").cast("string")),
        line("Content-Type", F.lit("text/html")),
        line("Content-Length", F.when(revisit, F.lit("0")).otherwise(F.col("bytes").cast("string"))),
        F.lit("\r\n"),
        F.when(revisit, "").otherwise(F.col("payload")),
    )
    page.select(record.alias("value")).write.option("lineSep", "\r\n\r\n").option("compression", compression).text(path)


class Files(InputPartition):
    def __init__(self, paths: list[str]):
        self.paths = paths


def _open(path: str):
    from pyarrow import fs

    where, name = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)
    raw = where.open_input_stream(name, compression=None)
    return gzip.GzipFile(fileobj=raw) if name.endswith(".gz") else io.BufferedReader(raw, 1 << 20)


def records(stream, accept, payload: bool) -> Iterator[tuple[dict[str, str], int, bytes | None]]:
    """(headers, content length, payload) of the records that accept(headers) takes."""
    while True:
        line = stream.readline()
        if not line:
            return
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {line[:40]!r}")
        headers = {}
        while (line := stream.readline()).strip():
            name, _, value = line.partition(b":")
            headers[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
        length = int(headers.get("content-length", 0))
        if not accept(headers):
            _skip(stream, length)
        elif payload:
            yield headers, length, stream.read(length)
        else:
            _skip(stream, length)
            yield headers, length, None


def _skip(stream, n: int) -> None:
    while n > 0:
        got = len(stream.read(min(n, 1 << 20)))
        if not got:
            return
        n -= got


class WarcReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.files = [x.rsplit("|", 1) for x in options.get("files", "").split("\n") if x]
        self.payload = options.get("payload", "true").lower() == "true"
        self.split, self.tests = int(options.get("split", 32 << 20)), []

    def pushFilters(self, filters):
        for f in filters:
            column = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if column not in HEADERS or not isinstance(f, (EqualTo, EqualNullSafe, In, IsNull, IsNotNull)):
                yield f
            elif isinstance(f, In):
                self.tests.append((HEADERS[column], {str(v) for v in f.value if v is not None}))
            elif isinstance(f, IsNull):
                self.tests.append((HEADERS[column], None))
            elif isinstance(f, IsNotNull):
                self.tests.append((HEADERS[column], True))
            else:
                self.tests.append((HEADERS[column], None if f.value is None else {str(f.value)}))

    def partitions(self):
        out, paths, size = [], [], 0
        for path, n in self.files:
            paths.append(path)
            size += int(n)
            if size >= self.split:
                out.append(Files(paths))
                paths, size = [], 0
        return [*out, Files(paths)] if paths or not out else out

    def _accept(self, headers: dict[str, str]) -> bool:
        return all((name in headers) if want is True else (name not in headers) if want is None else headers.get(name) in want for name, want in self.tests)

    def read(self, partition) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for path in partition.paths:
            with _open(path) as stream:
                for headers, length, payload in records(stream, self._accept, self.payload):
                    row = {c: headers.get(h) for c, h in HEADERS.items()}
                    for c in ("page_id", "payload_length"):
                        row[c] = int(row[c]) if row[c] else None
                    rows.append(row | {"content_length": length, "payload": payload})
                    size += 500 + (length if payload else 0)
                    if size > 4 << 20:
                        yield pa.RecordBatch.from_pylist(rows, ARROW)
                        rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, ARROW)


ARROW = pa.schema([(c, pa.int64() if c in ("page_id", "payload_length") else pa.string()) for c in HEADERS] + [("content_length", pa.int64()), ("payload", pa.binary())])


class WarcSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> WarcReader:
        return WarcReader(dict(self.options))


def read_warc(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """Records of the archives in a folder: header columns, content_length and, if asked for, payload."""
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    found = at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).listStatus(at)
    files = sorted((f.getPath().toString(), f.getLen()) for f in found if not f.isDirectory() and f.getPath().getName()[0] not in "_.")
    return spark.read.format("warc").option("files", "\n".join(f"{p}|{n}" for p, n in files)).option("payload", str(payload).lower()).load()


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def round_trip(spark: SparkSession, pages: DataFrame, path: str) -> DataFrame:
    """Write pages, read the archives back: (page_id, payload_bytes, payload_digest, record_type, refers_to).

    Of responses the bytes and the digest are those of the payload read back; of revisits, those of their headers.
    """
    write_warc(pages, path)
    number = F.regexp_extract("refers_to", "<urn:page:(-?[0-9]+)>", 1)
    response = read_warc(spark, path).where("warc_type = 'response'").select("page_id", F.octet_length("payload").cast("long").alias("payload_bytes"), base32(F.upper(F.sha1("payload"))).alias("payload_digest"), F.lit("response").alias("record_type"), F.lit(None).cast("long").alias("refers_to"))
    revisit = read_warc(spark, path, payload=False).where("warc_type = 'revisit'").select("page_id", F.col("payload_length").alias("payload_bytes"), F.substring("payload_digest", 6, 32).alias("payload_digest"), F.lit("revisit").alias("record_type"), number.cast("long").alias("refers_to"))
    return response.unionAll(revisit)
