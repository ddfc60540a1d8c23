"""Content-addressed WARC archive in two Parquet tables.

``payloads`` holds each distinct payload once (gzip member, SHA-256 as its address, the largest page id that has it);
``headers`` holds the exact header bytes of every record, with the address of the payload that follows them.  Records
are rebuilt by joining the two; a record is its header bytes, the payload if it is a response, and two line ends.
Reading parses the rebuilt records and verifies length and digests of every payload.

Of records with equal payloads of at least ``min_bytes`` the one with the largest page id is a response, the others
revisit it; smaller payloads are all responses.

Cases: a null text is an empty payload; a null URL leaves its header out, line ends in a URL are percent-encoded; a
null page id is written as an empty one, and such rows are responses only if no id has their payload; rows with the
same page id and payload are alike, responses or revisits together; an empty table gives an empty archive; further
columns aren't archived.
"""

from __future__ import annotations

import base64
import gzip
import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from merchant_signals.llm.common import arrow_map, staged
from merchant_signals.llm.words import texts_of

#: Every record's WARC-Date: archives of equal pages are equal.
WARC_DATE = "2024-01-01T00:00:00Z"
END = b"\r\n\r\n"


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _payloads(pages: DataFrame, id_col: str, payload_col: str) -> DataFrame:
    """digest, page_id, gz: of each batch's equal payloads, the one with the largest id."""

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        data, offset = texts_of(b.column(1))
        best: dict[bytes, tuple[int, int]] = {}
        for i, page in enumerate(b.column(0).to_pylist()):
            key = hashlib.sha256(data[offset[i]:offset[i + 1]]).digest()
            rank = (-(1 << 63) - 1 if page is None else page, i)
            if key not in best or rank > best[key]:
                best[key] = rank
        rows = [i for _, i in best.values()]
        return pa.RecordBatch.from_arrays(
            [pa.array([k.hex() for k in best]), b.column(0).take(pa.array(rows, pa.int32())),
             pa.array([gzip.compress(data[offset[i]:offset[i + 1]], 6, mtime=0) for i in rows], pa.binary())],
            names=["digest", "page_id", "gz"])

    found = arrow_map(pages.select(F.col(id_col).cast("long"), F.col(payload_col).cast("string")), run,
                      "digest string, page_id bigint, gz binary")
    return found.groupBy("digest").agg(F.max("page_id").alias("response_id"), F.first("gz").alias("gz"))


def _keys(pages: DataFrame, id_col: str, url_col: str, payload_col: str) -> DataFrame:
    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        data, offset = texts_of(b.column(2))
        parts = [data[offset[i]:offset[i + 1]] for i in range(b.num_rows)]
        return pa.RecordBatch.from_arrays(
            [b.column(0), b.column(1), pa.array([hashlib.sha256(p).hexdigest() for p in parts], pa.string()),
             pa.array([sha1_base32(p) for p in parts], pa.string()), pa.array([len(p) for p in parts], pa.int64())],
            names=["page_id", "url", "digest", "sha1", "size"])

    return arrow_map(pages.select(F.col(id_col).cast("long"), F.col(url_col).cast("string"), F.col(payload_col).cast("string")),
                     run, "page_id bigint, url string, digest string, sha1 string, size bigint")


def header_bytes(kind: str, page_id: int | None, url: str | None, sha1: str, size: int, refers_to: int | None) -> bytes:
    """All bytes of a record before its payload."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n").encode()
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>"]
    if url is not None:
        lines.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    lines += [f"WARC-Date: {WARC_DATE}", f"WARC-Payload-Digest: sha1:{sha1}"]
    if kind == "revisit":
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                  f"WARC-Refers-To: <urn:page:{refers_to}>"]
    length = len(http) + (size if kind == "response" else 0)
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {length}"]
    return "\r\n".join(lines).encode() + END + http


def write_archive(pages: DataFrame, path: str, min_bytes: int = 0, id_col: str = "page_id", url_col: str = "url",
                  payload_col: str = "html") -> None:
    spark = pages.sparkSession
    _payloads(pages, id_col, payload_col).write.parquet(f"{path}/payloads")
    stored = spark.read.parquet(f"{path}/payloads").select("digest", "response_id")
    own = _keys(pages, id_col, url_col, payload_col).join(stored, "digest", "left")
    first = (F.col("size") < min_bytes) | F.col("page_id").eqNullSafe(F.col("response_id"))

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        rows = b.to_pylist()
        return pa.RecordBatch.from_arrays(
            [pa.array([r["digest"] for r in rows], pa.string()), pa.array([r["kind"] for r in rows], pa.string()),
             pa.array([header_bytes(r["kind"], r["page_id"], r["url"], r["sha1"], r["size"], r["response_id"]) for r in rows],
                      pa.binary())], names=["digest", "kind", "header"])

    own = own.withColumn("kind", F.when(first, F.lit("response")).otherwise(F.lit("revisit")))
    arrow_map(own, run, "digest string, kind string, header binary").write.parquet(f"{path}/headers")


def _stored(spark: SparkSession, path: str) -> DataFrame:
    """digest, kind, header, and for responses gz."""
    headers, payloads = (spark.read.parquet(f"{path}/{t}") for t in ("headers", "payloads"))
    full = headers.where(F.col("kind") == "response").join(payloads.select("digest", "gz"), "digest")
    bare = headers.where(F.col("kind") == "revisit").withColumn("gz", F.lit(None).cast("binary"))
    cols = ["digest", "kind", "header", "gz"]
    return full.select(cols).unionByName(bare.select(cols))


def rebuild(header: bytes, gz: bytes | None) -> bytes:
    """The original bytes of a record."""
    return header + (b"" if gz is None else gzip.decompress(gz)) + END


def records(spark: SparkSession, path: str) -> DataFrame:
    """digest, kind and record: the original bytes of every record."""

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        whole = [rebuild(h.as_py(), z.as_py()) for h, z in zip(b.column("header"), b.column("gz"))]
        return pa.RecordBatch.from_arrays([b.column("digest"), b.column("kind"), pa.array(whole, pa.binary())],
                                          names=["digest", "kind", "record"])

    return arrow_map(_stored(spark, path), run, "digest string, kind string, record binary")


def parse_record(record: bytes) -> tuple[dict[str, str], bytes]:
    """The fields of a record and its payload, which the HTTP header in its block precedes."""
    head, _, rest = record.partition(END)
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError(f"not a WARC record: {version[:40]!r}")
    fields = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines)}
    block, end = rest[:int(fields["content-length"])], rest[int(fields["content-length"]):]
    if end != END:
        raise ValueError("a record ends with two line ends after Content-Length bytes")
    return fields, block.partition(END)[2]


def _page(urn: str | None) -> int | None:
    value = (urn or "").removeprefix("<urn:page:").removesuffix(">")
    return int(value) if value else None


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type and refers_to of every record; a payload whose length or
    digests aren't those of its headers or address fails the read."""

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        out: dict[str, list] = {k: [] for k in ("digest", "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")}
        for address, header, gz in zip(b.column("digest").to_pylist(), b.column("header"), b.column("gz")):
            fields, payload = parse_record(rebuild(header.as_py(), gz.as_py()))  # one record at a time
            sha1 = fields["warc-payload-digest"].removeprefix("sha1:")
            full = fields["warc-type"] == "response"
            if full and (sha1_base32(payload) != sha1 or hashlib.sha256(payload).hexdigest() != address):
                raise ValueError(f"payload of {fields['warc-record-id']} isn't that of its digest")
            for k, v in (("digest", address), ("page_id", _page(fields["warc-record-id"])), ("payload_digest", sha1),
                         ("payload_bytes", len(payload) if full else None), ("record_type", fields["warc-type"]),
                         ("refers_to", _page(fields.get("warc-refers-to")))):
                out[k].append(v)
        kinds = {"page_id": pa.int64(), "payload_bytes": pa.int64(), "refers_to": pa.int64()}
        return pa.RecordBatch.from_arrays([pa.array(v, kinds.get(k, pa.string())) for k, v in out.items()], names=[*out])

    schema = "digest string, page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"
    read = staged(arrow_map(_stored(spark, path), run, schema), "warc-read")
    # a revisit's full payload is that of the response it refers to, which the read has verified
    sizes = read.where(F.col("record_type") == "response").groupBy(F.col("digest").alias("d")).agg(
        F.max("payload_bytes").alias("full_bytes"))
    cols = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    back = (read.where(F.col("record_type") == "revisit").join(sizes, F.col("digest") == F.col("d"))
            .withColumn("payload_bytes", F.col("full_bytes")))
    return read.where(F.col("record_type") == "response").select(cols).unionByName(back.select(cols))
