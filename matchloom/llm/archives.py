"""WARC archives: written and read by the executors through pyarrow's file systems, with revisits resolved by payload digest."""

from __future__ import annotations

import gzip
import hashlib
import uuid
from collections.abc import Iterator
from io import BufferedReader

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchloom.llm.shared import materialize, new_path, only, partitions

#: Smaller payloads are never revisits.
LEAST = 100
_EPOCH = "2000-01-01T00:00:00Z"


def _headers(kind: str, record_id: str, fields: list[tuple[str, str]], length: int) -> bytes:
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {record_id}", f"WARC-Date: {_EPOCH}"]
    lines += [f"{k}: {v}" for k, v in fields]
    return ("\r\n".join([*lines, f"Content-Length: {length}"]) + "\r\n\r\n").encode()


def _uri(url: str | None) -> str:
    """A header's value is one line."""
    return "".join(c for c in url or "" if c.isprintable())


def _record_id(kind: str, page_id: int | None, digest: str, repeated: bool) -> str:
    """The same for a page and payload in every run; where several rows have both, a random one for each."""
    own = uuid.uuid4() if repeated else uuid.uuid5(uuid.NAMESPACE_URL, f"{kind}:{'' if page_id is None else page_id}:{digest}")
    return f"<urn:uuid:{own}>"


def record(page_id: int | None, url: str | None, digest: str, payload: bytes, refers_to: int | None, revisit: bool, repeated: bool = False, unclear: bool = False) -> bytes:
    """One record in a gzip member of its own. A revisit has fresh headers and no block.

    ``repeated``: other rows have the same page_id and payload. ``unclear``: so have others of the response that a revisit refers to, so that
    it names the page and the payload, but no record.
    """
    name, kind = "" if page_id is None else str(page_id), "revisit" if revisit else "response"
    fields = [("WARC-Target-URI", _uri(url)), ("WARC-Payload-Digest", f"sha256:{digest}"), ("X-Page-Id", name)]
    if revisit:
        fields += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("X-Refers-To-Page-Id", str(refers_to))]
        fields += [] if unclear else [("WARC-Refers-To", _record_id("response", refers_to, digest, False))]
        payload = b""
    head = _headers(kind, _record_id(kind, page_id, digest, repeated), [*fields, ("Content-Type", "text/html; charset=utf-8")], len(payload))
    return gzip.compress(head + payload + b"\r\n\r\n", 1, mtime=0)


def read_records(stream: BufferedReader) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and blocks of an uncompressed stream; a block's end is where its Content-Length says, whatever it holds."""
    while True:
        line = stream.readline()
        if not line:
            return
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {line[:40]!r}")
        headers: dict[str, str] = {}
        while (line := stream.readline()).strip():
            key, _, value = line.decode().partition(":")
            headers[key] = value.strip()
        size = int(headers["Content-Length"])
        block = stream.read(size)
        if len(block) != size:
            raise ValueError("a record is cut short")
        yield headers, block


def resolve_revisits(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """page_id, url, html, digest, refers_to, revisit, repeated and unclear: of equal payloads of ``least`` bytes or more, the least page_id is the response.

    Headers (digest and page_id, no payloads) are aggregated and shuffled, first by page and digest, then by digest; they then meet the first of
    their digest, where a hot digest's headers go to several tasks, since both sides of that join are plain exchanges. Payloads only ever
    move by page, and not at all where few pages are revisits.
    """
    rows = only(pages, page_id="long", url="string", html="string")
    body = F.coalesce("html", F.lit("")).cast("binary")
    rows = rows.withColumns({"digest": F.sha2(body, 256), "n_bytes": F.octet_length(body).cast("long")})
    headers = materialize(rows.groupBy("page_id", "digest").agg(F.count(F.lit(1)).alias("n"), F.first("n_bytes").alias("n_bytes")), "warc-headers")
    named = F.when(F.col("page_id").isNotNull(), F.struct("page_id", "n"))
    first = headers.where(F.col("n_bytes") >= least).groupBy("digest").agg(F.min(named).alias("first"), F.count(F.lit(1)).alias("pages")).where("pages > 1")
    first = materialize(first.where("first IS NOT NULL").select("digest", F.col("first.page_id").alias("first"), (F.col("first.n") > 1).alias("unclear")), "warc-first")
    marks = headers.join(first, "digest", "left").withColumns({"refers_to": F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")), "repeated": F.col("n") > 1})
    marks = marks.where("refers_to IS NOT NULL OR repeated").select(F.col("page_id").alias("of_page"), F.col("digest").alias("of_digest"), "refers_to", "repeated", "unclear")
    found = rows.join(marks, F.col("page_id").eqNullSafe(F.col("of_page")) & (F.col("digest") == F.col("of_digest")), "left")
    no = F.lit(False)
    return found.select("page_id", "url", "html", "digest", "refers_to", F.col("refers_to").isNotNull().alias("revisit"), F.coalesce("repeated", no).alias("repeated"), F.coalesce("unclear", no).alias("unclear"))


def write_archives(resolved: DataFrame, folder: str, file_bytes: int = 64 << 20) -> DataFrame:
    """Writes the records into ``folder`` as ``*.warc.gz``, about ``file_bytes`` each, and returns the list of files.

    A task writes files of its own, named by a random number, and lists them in its output; those of a task that failed or ran twice
    aren't in the list, so every record is in just one listed file.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        out, files, size = None, [], 0
        for batch in batches:
            for row in zip(*[batch.column(i) for i in range(batch.num_columns)], strict=True):
                page_id, url, html, digest, refers_to, revisit, repeated, unclear = (x.as_py() for x in row)
                if out is None or size >= file_bytes:
                    if out is not None:
                        out.close()
                    files.append(f"{root}/{uuid.uuid4().hex}.warc.gz")
                    out, size = store.open_output_stream(files[-1], compression=None), 0
                raw = record(page_id, url, digest, (html or "").encode(), refers_to, revisit, repeated, unclear)
                out.write(raw)
                size += len(raw)
        if out is not None:
            out.close()
        yield pa.RecordBatch.from_arrays([pa.array(files, pa.string())], names=["file"])

    return materialize(resolved.mapInArrow(run, "file string"), "warc-files")


def read_archives(spark: SparkSession, files: DataFrame, folder: str, with_block: bool = False) -> DataFrame:
    """page_id, url, record_type, payload_digest (of the header), payload_bytes and block_digest (of the block; null for revisits), refers_to, record_id, refers_to_id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for file in batch.column(0).to_pylist():
                rows: list[tuple] = []
                held = 0
                with store.open_input_stream(file, compression=None) as raw, gzip.GzipFile(fileobj=raw) as plain, BufferedReader(plain, 1 << 20) as stream:
                    for h, block in read_records(stream):
                        revisit = h["WARC-Type"] == "revisit"
                        number = lambda k, h=h: int(h[k]) if h.get(k) else None
                        rows.append((number("X-Page-Id"), h["WARC-Target-URI"], h["WARC-Type"], h["WARC-Payload-Digest"].removeprefix("sha256:"), None if revisit else len(block), None if revisit else hashlib.sha256(block).hexdigest(), number("X-Refers-To-Page-Id"), block if with_block else None, h["WARC-Record-ID"], h.get("WARC-Refers-To")))
                        held += len(block) if with_block else 0
                        if len(rows) >= 5000 or held > 8 << 20:
                            yield _batch(rows)
                            rows, held = [], 0
                yield _batch(rows)

    n = max(1, partitions(spark))
    return files.repartition(n).mapInArrow(run, "page_id long, url string, record_type string, payload_digest string, payload_bytes long, block_digest string, refers_to long, block binary, record_id string, refers_to_id string")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names = ["page_id", "url", "record_type", "payload_digest", "payload_bytes", "block_digest", "refers_to", "block", "record_id", "refers_to_id"]
    kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary(), pa.string(), pa.string()]
    columns = list(zip(*rows, strict=True)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def deduplicate(pages: DataFrame, folder: str | None = None, least: int = LEAST) -> DataFrame:
    """Writes the pages to archives and reads them back: page_id, payload_bytes, payload_digest, record_type, refers_to.

    A revisit's size comes from the response it refers to, met by digest after reading; a response whose block doesn't have the digest
    of its header raises an error. Null html is an empty payload and a null page_id stays null; among equal payloads null is never
    the least. A page_id that comes twice with the same payload gives two responses, each with a record id of its own. Payloads of any length
    are taken whole. No pages, no files. Other columns, whatever their names, are left out.
    """
    spark = pages.sparkSession
    folder = folder or new_path(spark, "warc")
    files = write_archives(resolve_revisits(pages, least), folder)
    back = materialize(read_archives(spark, files, folder).drop("block", "url", "record_id", "refers_to_id"), "warc-read")
    sizes = materialize(back.where("record_type = 'response'").groupBy("payload_digest").agg(F.max("payload_bytes").alias("n")), "warc-sizes")
    told = back.where("record_type = 'revisit'").drop("payload_bytes").join(sizes, "payload_digest").withColumnRenamed("n", "payload_bytes")
    good = F.when(F.col("block_digest") == F.col("payload_digest"), F.col("payload_digest")).otherwise(F.raise_error(F.lit("a record's block doesn't have its digest")))
    own = back.where("record_type = 'response'").withColumn("payload_digest", good)
    return own.unionByName(told).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_revisits(spark, sf_dir: str) -> DataFrame:
    """The query: all pages."""
    return deduplicate(spark.read.parquet(f"{sf_dir}/pages.parquet"))
