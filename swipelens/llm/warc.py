"""WARC archives: write captures, read records, assemble transactions.

A capture is three records: the request, the response (or a revisit of an earlier response
with the same payload) and metadata. The request and the metadata name the response in
``WARC-Concurrent-To``. Reading gives one row per record; assembly joins requests and metadata
to their response over that identifier and emits one nested row per capture.

Archives are gzip members, one per record, in files of about ``ARCHIVE_BYTES``. Tasks write
them under fixed names and read them member by member, so a task holds one file and one
record. Record identifiers are derived from archive and row number, and so stay the same when
a task runs again.

Edge cases: a null page is an empty payload. Null ids and urls are kept in the metadata. Of
equal payloads with equal ids one is the response. Repeated rows are captures of their own.
A capture without request or metadata has null there; of several, that with the smallest
identifier is kept and ``n_requests`` and ``n_metadata`` count them. An empty table gives no
archive and an empty result. Further columns of the pages are not stored.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from swipelens.llm import files
from swipelens.llm.common import ship, whole
from swipelens.session import materialize, new_path
from swipelens.sizing import broadcast_if_small

ARCHIVE_BYTES = 8 << 20
#: Payloads of at least so many bytes are stored once.
REVISIT_BYTES = 1000
DATE = "2024-01-01T00:00:00Z"
#: Rows or bytes per batch of records that a reading task hands on.
BATCH_ROWS, BATCH_BYTES = 2000, 16 << 20
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

MANIFEST = "name STRING, n_captures BIGINT"
RECORD = (
    "record_type STRING, record_id STRING, concurrent_to STRING, refers_to STRING, target_uri STRING, "
    "date STRING, content_type STRING, payload_bytes BIGINT, payload_digest STRING, digest_ok BOOLEAN, "
    "page_id BIGINT, url STRING, payload BINARY"
)
_COLUMNS = [f.split()[0] for f in RECORD.split(", ")]


def record_id(archive: str, row: int, kind: str) -> str:
    return f"<{uuid.uuid5(uuid.NAMESPACE_URL, f'{archive}/{row}/{kind}').urn}>"


def header_safe(url: str) -> str:
    """The url with everything that could end or garble a header line percent-encoded."""
    return "".join(c if "!" <= c <= "~" else "".join(f"%{b:02X}" for b in c.encode("utf-8", "replace")) for c in url)


def record(headers: list[tuple[str, str | None]], block: bytes) -> bytes:
    lines = [VERSION, *(f"{k}: {v}".encode() for k, v in headers if v is not None), b"Content-Length: %d" % len(block)]
    packer = zlib.compressobj(6, wbits=31)
    return packer.compress(b"\r\n".join(lines) + b"\r\n\r\n" + block + b"\r\n\r\n") + packer.flush()


def capture(archive: str, row: int, page_id: int | None, url: str | None, payload: bytes, sha1: str, refers: int | None) -> bytes:
    """The records of one capture; ``refers`` is the row whose response has this payload."""
    uri = None if url is None else header_safe(url)
    response = record_id(archive, row, "response")
    digest = "sha1:" + base64.b32encode(bytes.fromhex(sha1)).decode()
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    shared = [("WARC-Date", DATE), ("WARC-Target-URI", uri)]
    if refers is None:
        main = record(
            [("WARC-Type", "response"), ("WARC-Record-ID", response), *shared, ("WARC-Payload-Digest", digest),
             ("Content-Type", "application/http; msgtype=response")], http + payload,
        )
    else:
        main = record(
            [("WARC-Type", "revisit"), ("WARC-Record-ID", response), *shared, ("WARC-Payload-Digest", digest),
             ("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(archive, refers, "response")),
             ("Content-Type", "application/http; msgtype=response")], http,
        )
    request = record(
        [("WARC-Type", "request"), ("WARC-Record-ID", record_id(archive, row, "request")), *shared,
         ("WARC-Concurrent-To", response), ("Content-Type", "application/http; msgtype=request")],
        f"GET {uri or '/'} HTTP/1.1\r\n\r\n".encode(),
    )
    about = json.dumps({"page_id": page_id, "url": url})
    metadata = record(
        [("WARC-Type", "metadata"), ("WARC-Record-ID", record_id(archive, row, "metadata")), *shared,
         ("WARC-Concurrent-To", response), ("Content-Type", "application/warc-fields")],
        f"capture: {about}\r\n".encode(),
    )
    return request + main + metadata


def _write(folder: str, archive: str, archive_bytes: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        partition, part, held, size, captures = TaskContext.get().partitionId(), 0, [], 0, 0

        def close() -> pd.DataFrame:
            nonlocal part, held, size, captures
            name = f"part-{partition:06d}-{part:06d}.warc.gz"
            files.put(folder, name, b"".join(held))
            row = pd.DataFrame({"name": [name], "n_captures": [captures]})
            part, held, size, captures = part + 1, [], 0, 0
            return row

        for batch in batches:
            columns = (batch[c] for c in ("row", "page_id", "url", "payload", "sha1", "refers"))
            for row, page_id, url, payload, sha1, refers in zip(*columns):
                page_id, refers = (None if pd.isna(x) else int(x) for x in (page_id, refers))
                data = capture(archive, int(row), page_id, url, bytes(payload), sha1, refers)
                held.append(data)
                size, captures = size + len(data), captures + 1
                if size >= archive_bytes:
                    yield close()
        if held:
            yield close()

    return run


def write(
    pages: DataFrame, folder: str, id_col: str = "page_id", url: str = "url", html: str = "html",
    revisit_bytes: int = REVISIT_BYTES, archive_bytes: int = ARCHIVE_BYTES,
) -> DataFrame:
    """Write the archives of a table of pages. Returns the manifest.

    The pages are written once with digest and row number. Only payloads that occur twice
    take part in a join: their digests are counted on the map side and broadcast below a
    counted bound.
    """
    ship(pages.sparkSession)
    payload = whole(html).cast("binary")
    staged = materialize(
        pages.select(
            F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("bigint").alias("page_id"),
            F.col(url).alias("url"), payload.alias("payload"), F.sha1(payload).alias("sha1"),
            F.octet_length(payload).alias("n_bytes"),
        )
    )
    groups = staged.where(F.col("n_bytes") >= revisit_bytes).groupBy("sha1", "n_bytes").agg(
        F.count(F.lit(1)).alias("n"),
        # Null ids come first and so lose; of equal ids the smallest row number wins.
        F.max(F.struct("page_id", (-F.col("row")).alias("minus"))).alias("first"),
    )
    repeated = materialize(groups.where("n > 1").select("sha1", "n_bytes", (-F.col("first.minus")).alias("first")))
    linked = staged.join(broadcast_if_small(repeated), ["sha1", "n_bytes"], "left").withColumn(
        "refers", F.when(F.col("first") != F.col("row"), F.col("first"))
    )
    archive = folder.rstrip("/").rpartition("/")[2]
    linked = linked.select("row", "page_id", "url", "payload", "sha1", "refers")
    # Nullable integers travel as text, so that none is rounded on its way through pandas.
    linked = linked.withColumns({"page_id": F.col("page_id").cast("string"), "refers": F.col("refers").cast("string")})
    return materialize(linked.mapInPandas(_write(folder, archive, archive_bytes), MANIFEST))


def members(data: bytes) -> Iterator[bytes]:
    """The gzip members of a file, one after the other."""
    view, at, piece = memoryview(data), 0, 1 << 14
    while at < len(view):
        unpack, out = zlib.decompressobj(wbits=31), []
        while not unpack.eof:
            if at >= len(view):
                raise ValueError("the archive ends inside a record")
            out.append(unpack.decompress(view[at:at + piece]))
            at = min(len(view), at + piece) - len(unpack.unused_data)
        yield b"".join(out)


def parse(data: bytes, with_payload: bool) -> tuple:
    """One record as a row of ``RECORD``."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
    block = rest[:int(headers["content-length"])]
    kind, page_id, url, payload, n_bytes, ok = headers["warc-type"], None, None, None, None, None
    digest = headers.get("warc-payload-digest")
    if digest and digest.startswith("sha1:"):
        digest = base64.b32decode(digest[5:]).hex()
    if kind in ("response", "revisit"):
        http, _, body = block.partition(b"\r\n\r\n")
        lengths = [int(x.partition(b":")[2]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")]
        n_bytes = lengths[0] if kind == "revisit" and lengths else len(body)
        if kind == "response":
            found = hashlib.sha1(body).hexdigest()
            payload, ok, digest = body, digest in (None, found), found
    elif kind == "metadata":
        for line in block.decode("utf-8").split("\r\n"):
            if line.startswith("capture: "):
                about = json.loads(line[9:])
                page_id, url = about["page_id"], about["url"]
    return (
        kind, headers.get("warc-record-id"), headers.get("warc-concurrent-to"), headers.get("warc-refers-to"),
        headers.get("warc-target-uri"), headers.get("warc-date"), headers.get("content-type"), n_bytes, digest, ok,
        page_id, url, payload if with_payload else None,
    )


def read_records(spark: SparkSession, folder: str, with_payload: bool = True) -> DataFrame:
    """One row per record of the archives of a folder."""
    ship(spark)

    def frame(rows: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(rows, columns=_COLUMNS, dtype=object).astype({"payload_bytes": "Int64", "page_id": "Int64", "digest_ok": "boolean"})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for data in batch["content"]:
                rows, size = [], 0
                for member in members(data):
                    rows.append(parse(member, with_payload))
                    size += len(member) if with_payload else 0
                    if len(rows) >= BATCH_ROWS or size >= BATCH_BYTES:
                        yield frame(rows)
                        rows, size = [], 0
                if rows:
                    yield frame(rows)

    archives = spark.read.format("binaryFile").option("pathGlobFilter", "part-*.warc.gz").load(folder)
    return archives.select("content").mapInPandas(run, RECORD)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: ``response`` with its ``request`` and ``metadata``.

    ``records`` is read three times; write it first if that costs more than the write.
    """
    def partner(kind: str, count: str, *fields: str) -> DataFrame:
        return (
            records.where(F.col("record_type") == kind).where(F.col("concurrent_to").isNotNull())
            .groupBy("concurrent_to").agg(
                F.min_by(F.struct("record_id", "date", "content_type", *fields), "record_id").alias(kind),
                F.count(F.lit(1)).alias(count),
            )
        )

    captures = records.where(F.col("record_type").isin("response", "revisit"))
    fields = [c for c in records.columns if c not in ("concurrent_to", "page_id", "url")]
    nested = captures.select("record_id", F.struct(*fields).alias("response"))
    for kind, count, extra in (("request", "n_requests", ["target_uri"]), ("metadata", "n_metadata", ["page_id", "url"])):
        found = partner(kind, count, *extra)
        nested = nested.join(found, nested["record_id"] == found["concurrent_to"], "left").drop("concurrent_to")
    zero = F.lit(0).cast("bigint")
    return nested.withColumns({c: F.coalesce(c, zero) for c in ("n_requests", "n_metadata")})


def orphans(records: DataFrame) -> DataFrame:
    """Requests and metadata whose response is in none of the archives."""
    captures = records.where(F.col("record_type").isin("response", "revisit")).select(F.col("record_id").alias("_id"))
    others = records.where(F.col("record_type").isin("request", "metadata"))
    return others.join(captures, others["concurrent_to"] == captures["_id"], "left_anti")


def capture_report(pages: DataFrame) -> DataFrame:
    """Write the archives to a new shared folder, read them back and report every page."""
    spark = pages.sparkSession
    folder = new_path(spark)
    if not write(pages, folder).head(1):
        return spark.createDataFrame(
            [], "page_id BIGINT, payload_bytes BIGINT, payload_digest STRING, record_type STRING, refers_to BIGINT"
        )
    captures = assemble(materialize(read_records(spark, folder, with_payload=False)))
    flat = materialize(
        captures.select(
            "record_id", F.col("metadata.page_id").alias("page_id"), "response.payload_bytes", "response.payload_digest",
            "response.record_type", F.col("response.refers_to").alias("_refers"),
        )
    )
    named = flat.where("record_type = 'response'").select(
        F.col("record_id").alias("_id"), F.col("page_id").alias("refers_to")
    )
    # Only revisits need a partner, so the other rows do not travel.
    revisits = flat.where(F.col("_refers").isNotNull())
    known = revisits.join(named, revisits["_refers"] == named["_id"], "left").drop("_id")
    alone = flat.where(F.col("_refers").isNull()).withColumn("refers_to", F.lit(None).cast("bigint"))
    return known.unionByName(alone).drop("_refers", "record_id")
