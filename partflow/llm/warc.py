"""WARC archives of web pages, and reading them by boundary-chain verification.

Writing: payloads are digested and counted; of equal payloads of some size the
largest page keeps the body and the others become revisit records. The records
are lines of a text output whose line separator is the one that ends a WARC
record, so Spark writes and commits the archives like any output.

Reading: a task looks for the version line at every offset of its archive, also
inside payloads, and gives each finding a successor: the offset at which its
record, by its own length, ends. Which findings are records follows from the
chain that starts at the start of the file; pointer jumping finds all of it in
as many rounds as the length of the longest chain has bits.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from partflow.session import materialize

END, VERSION = "\r\n\r\n", "WARC/1.0\r\n"
#: Payloads of at least so many bytes are stored once.
LEAST_SHARED = 1000
RECORDS_PER_ARCHIVE = 1000
_MAGIC = re.compile(re.escape(VERSION.encode()))
_PAGE = re.compile(rb"<urn:page:(-?\d+)>")


def decided(pages: DataFrame) -> DataFrame:
    """``pages`` with digest and size of the payload, and the page it revisits, if any."""
    body = F.coalesce("html", F.lit(""))
    paid = pages.select("page_id", "url", body.alias("body"), F.sha1(F.encode(body, "utf-8")).alias("digest"), F.octet_length(body).cast("long").alias("size"))
    copies = paid.filter(F.col("size") >= LEAST_SHARED).groupBy("digest").agg(F.max("page_id").alias("last"), F.count(F.lit(1)).alias("n"))
    # Payloads that occur once need no decision, so this table is small beside the pages.
    shared = materialize(copies.filter("n > 1 and last is not null").select("digest", "last"), "warc-shared")
    joined = paid.join(shared, "digest", "left")
    return joined.withColumn("refers_to", F.when(F.col("page_id").isNull() | (F.col("page_id") < F.col("last")), F.col("last"))).drop("last")


def write_archives(pages: DataFrame, path: str, records: int = RECORDS_PER_ARCHIVE) -> None:
    """One record per row of (page_id, url, html); gzip archives of at most ``records``.

    A null html is an empty payload, a null page_id or url an empty name; line
    ends in a url become blanks. Rows that repeat a page and its payload are
    records of their own, none of them a revisit. Other columns take no part.
    """
    line = "\r\n"

    def name(c: str):
        return F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit(">"))

    revisit = F.col("refers_to").isNotNull()
    head = F.concat(
        F.lit(f"{VERSION}WARC-Type: "),
        F.when(revisit, "revisit").otherwise("response"),
        F.lit(f"{line}WARC-Record-ID: "),
        name("page_id"),
        F.lit(f"{line}WARC-Date: 1970-01-01T00:00:00Z{line}WARC-Target-URI: "),
        F.regexp_replace(F.coalesce("url", F.lit("")), "[\r\n]+", " "),
        F.lit(f"{line}WARC-Payload-Digest: sha1:"),
        F.col("digest"),
        F.lit(f"{line}X-Payload-Length: "),
        F.col("size").cast("string"),
        F.when(revisit, F.concat(F.lit(f"{line}WARC-Profile: http://netpreserve.org/warc/1.0/revisit/identical-payload-digest{line}WARC-Refers-To: "), name("refers_to"))).otherwise(F.lit("")),
        F.lit(f"{line}Content-Type: text/html; charset=utf-8{line}Content-Length: "),
        F.when(revisit, "0").otherwise(F.col("size").cast("string")),
        F.lit(END),
    )
    record = F.concat(head, F.when(revisit, "").otherwise(F.col("body"))).alias("value")
    (
        decided(pages)
        .select(record)
        .write.option("lineSep", END)
        .option("compression", "gzip")
        .option("maxRecordsPerFile", records)
        .text(path)
    )


FOUND = "file string, at long, next long, page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, intact boolean, payload binary"


def _page(value: bytes | None) -> int | None:
    got = _PAGE.fullmatch(value or b"")
    return int(got[1]) if got else None


def _finding(file: str, data: bytes, at: int, payloads: bool) -> tuple | None:
    """What the version line at ``at`` would mean if it began a record."""
    end = data.find(END.encode(), at)
    if end < 0:
        return None
    head = dict(x.split(b": ", 1) for x in data[at:end].split(b"\r\n")[1:] if b": " in x)
    length = head.get(b"Content-Length", b"")
    if not length.isdigit():
        return None
    begin = end + len(END)
    stop = begin + int(length)
    if data[stop : stop + len(END)] != END.encode():
        return None
    payload, kind = data[begin:stop], head.get(b"WARC-Type", b"").decode("ascii", "replace")
    digest = head.get(b"WARC-Payload-Digest", b"").removeprefix(b"sha1:").decode("ascii", "replace")
    intact = kind == "revisit" or hashlib.sha1(payload).hexdigest() == digest
    full = head.get(b"X-Payload-Length", b"")
    size = int(full) if kind == "revisit" and full.isdigit() else len(payload)
    return (file, at, stop + len(END), _page(head.get(b"WARC-Record-ID")), size, digest, kind, _page(head.get(b"WARC-Refers-To")), intact, payload if payloads else None)


def findings(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """Every place that looks like a record of the archives below ``path``."""
    schema = T.StructType.fromDDL(FOUND)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.name for f in schema.fields]
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.bool_(), pa.binary()]
        for batch in batches:
            for k in range(batch.num_rows):
                file = batch.column(0)[k].as_py()
                data = zlib.decompress(batch.column(1)[k].as_buffer(), 31)
                rows = [x for m in _MAGIC.finditer(data) if (x := _finding(file, data, m.start(), payloads))]
                columns = zip(*rows) if rows else [[]] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds)], names=names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("path", "content")
    return files.mapInArrow(run, schema)


def reachable(found: DataFrame) -> DataFrame:
    """The (file, at) of ``found`` on the chain of successors from the file's start."""
    step = materialize(found.select("file", "at", "next", (F.col("at") == 0).alias("on")), "warc-chain")
    known = step.filter("on").count()
    while True:
        ahead = step.select("file", F.col("at").alias("next"), F.col("next").alias("then"))
        reached = step.filter("on").select("file", F.col("next").alias("at"), F.lit(True).alias("hit")).distinct()
        step = materialize(
            step.join(ahead, ["file", "next"], "left")
            .join(reached, ["file", "at"], "left")
            .select("file", "at", F.coalesce("then", F.lit(-1)).alias("next"), (F.col("on") | F.col("hit").isNotNull()).alias("on")),
            "warc-chain",
        )
        now = step.filter("on").count()
        if now == known:
            return step.filter("on").select("file", "at")
        known = now


def read_archives(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """The records below ``path``: page_id, payload_bytes, payload_digest, record_type,
    refers_to, whether the stored payload has its digest, and the payload if asked for.

    An archive without a record at its start gives none; text after a broken
    record is not read, as its chain ends there.
    """
    found = findings(spark, path, payloads)
    if not payloads:
        found = materialize(found, "warc-findings")
    return found.join(reachable(found), ["file", "at"], "left_semi").drop("file", "at", "next")
