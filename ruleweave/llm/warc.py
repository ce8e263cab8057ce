"""WARC archives through Spark's own readers and writers: records with segments, chunked framing and revisits.

Writing: a payload becomes an HTTP block, in chunked transfer framing if it is long; a block longer than a segment is cut
into a first record and ``continuation`` records. Spark writes the records of a task into gzip files of a bounded
number of records. A payload that another record holds already is a ``revisit`` without one.

Reading: archives are parsed record by record. Whole records are decoded where they are read. Segments are brought
together by the identifier of their origin and ordered by their number; the block is joined, its length compared with
the total of the last segment, the transfer framing taken off, and the digest compared. What does not fit keeps its
record, with a status that says why, and never ends the job.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import re
import zlib
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ruleweave.operators.stages import lookup_join, materialize, skew_join

SEGMENT_BYTES = 16 * 1024
CHUNK_BYTES = 4 * 1024
# With segments of 16 KiB an archive holds 64 MB of records at most before compression.
RECORDS_PER_ARCHIVE = 4_096
# Payloads below this size are never revisits.
LEAST_REVISIT = 100
# Bytes of blocks in one Arrow batch that a task hands back.
BATCH_BYTES = 4 << 20

_VERSION = b"WARC/1.1\r\n"
_UNSAFE = re.compile(r"[\x00-\x20\x7f]")
_RECORD = "record_id string, record_type string, target_uri string, label string, payload_digest string, refers_to string"
_SEGMENT = f"{_RECORD}, segment long, total_length long, status string, block binary"
_DECODED = f"{_RECORD}, status string, payload binary"


def chunked(payload: bytes, size: int) -> bytes:
    """Chunked transfer framing, without trailers."""
    parts = [b"%x\r\n%b\r\n" % (len(c), c) for c in (payload[i : i + size] for i in range(0, len(payload), size))]
    return b"".join(parts) + b"0\r\n\r\n"


def unchunked(body: bytes) -> bytes | None:
    """The payload of a chunked body; None if the framing is broken. Extensions and trailers are passed over."""
    parts, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        digits = body[at:end].split(b";", 1)[0].strip() if end >= 0 else b""
        if not re.fullmatch(rb"[0-9A-Fa-f]{1,15}", digits):
            return None
        size, at = int(digits, 16), end + 2
        if not size:
            break
        if body[at + size : at + size + 2] != b"\r\n":
            return None
        parts.append(body[at : at + size])
        at += size + 2
    # Trailers, if any, and the empty line that ends them.
    return b"".join(parts) if body[at : at + 2] == b"\r\n" or body.endswith(b"\r\n\r\n") and at <= len(body) - 4 else None


def http_block(payload: bytes | None, chunk_bytes: int) -> bytes:
    """An HTTP response; with no payload, its header only."""
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    if payload is None:
        return head + b"\r\n"
    if len(payload) > chunk_bytes:
        return head + b"Transfer-Encoding: chunked\r\n\r\n" + chunked(payload, chunk_bytes)
    return head + b"Content-Length: %d\r\n\r\n" % len(payload) + payload


def http_payload(block: bytes) -> tuple[bytes | None, str]:
    """(payload, status) of an HTTP response; ``bad_framing`` if its length or its chunks do not fit."""
    head, parted, body = block.partition(b"\r\n\r\n")
    if not parted:
        return None, "bad_framing"
    fields = {}
    for line in head.split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        fields[name.strip().lower()] = value.strip().lower()
    if fields.get(b"transfer-encoding", b"").split(b",")[-1].strip() == b"chunked":
        payload = unchunked(body)
        return payload, "ok" if payload is not None else "bad_framing"
    length = fields.get(b"content-length", b"%d" % len(body))
    return (body, "ok") if length == b"%d" % len(body) else (None, "bad_framing")


def _record(fields: dict[str, str | None], block: bytes) -> bytes:
    lines = [f"{name}: {value}\r\n" for name, value in fields.items() if value is not None]
    return _VERSION + "".join(lines).encode() + b"Content-Length: %d\r\n\r\n" % len(block) + block + b"\r\n\r\n"


def _escaped(uri: str | None) -> str | None:
    return uri and _UNSAFE.sub(lambda m: f"%{ord(m[0]):02X}", uri)


def warc_records(row: dict, date: str, segment_bytes: int, chunk_bytes: int) -> Iterator[bytes]:
    """The records of one row: one, or as many as its block has segments."""
    revisit = row["record_type"] == "revisit"
    block = http_block(None if revisit else row["payload"], chunk_bytes)
    fields = {
        "WARC-Type": row["record_type"],
        "WARC-Record-ID": f"<{row['record_id']}>",
        "WARC-Date": date,
        "WARC-Target-URI": _escaped(row["target_uri"]),
        "WARC-Payload-Digest": f"sha256:{row['payload_digest']}",
        "Record-Label": _escaped(row["label"]),
        "Content-Type": "application/http; msgtype=response",
    }
    if revisit:
        fields["WARC-Refers-To"] = f"<{row['refers_to']}>"
        fields["WARC-Profile"] = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
    if len(block) <= segment_bytes:
        yield _record(fields, block)
        return
    pieces = [block[i : i + segment_bytes] for i in range(0, len(block), segment_bytes)]
    yield _record(fields | {"WARC-Segment-Number": "1"}, pieces[0])
    for number, piece in enumerate(pieces[1:], 2):
        more = {
            "WARC-Type": "continuation",
            "WARC-Record-ID": f"<{row['record_id']}.{number}>",
            "WARC-Date": date,
            "WARC-Segment-Origin-ID": f"<{row['record_id']}>",
            "WARC-Segment-Number": str(number),
            "WARC-Segment-Total-Length": str(len(block)) if number == len(pieces) else None,
        }
        yield _record(more, piece)


def _write(batches: Iterator[pa.RecordBatch], date: str, segment_bytes: int, chunk_bytes: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out, held = [], 0
        names = batch.schema.names
        for values in zip(*batch.columns):
            row = {name: value.as_py() for name, value in zip(names, values)}
            for record in warc_records(row, date, segment_bytes, chunk_bytes):
                # The text writer ends each value with a line feed, the last byte of a record.
                out.append(record[:-1])
                held += len(record)
                if held > BATCH_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])
                    out, held = [], 0
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])


def write_archives(
    records: DataFrame,
    path: str,
    *,
    date: str = "2000-01-01T00:00:00Z",
    segment_bytes: int = SEGMENT_BYTES,
    chunk_bytes: int = CHUNK_BYTES,
    records_per_archive: int = RECORDS_PER_ARCHIVE,
) -> None:
    """Write records (record_id, record_type, target_uri, label, payload, payload_digest, refers_to) as gzip WARC files.

    ``record_type`` is ``response`` or ``revisit``; ``payload`` is binary and not written for revisits; ``refers_to`` is the
    record a revisit stands for. Missing URIs and labels are left out; white space and control characters in them
    are percent-encoded. Other columns are ignored. No records give a folder without archives that hold any.
    """
    columns = ["record_id", "record_type", "target_uri", "label", "payload", "payload_digest", "refers_to"]
    write = partial(_write, date=date, segment_bytes=segment_bytes, chunk_bytes=chunk_bytes)
    lines = records.select(*columns).mapInArrow(write, "record binary").select(F.col("record").cast("string").alias("value"))
    lines.write.option("compression", "gzip").option("maxRecordsPerFile", records_per_archive).text(path)


class _Damaged(Exception):
    pass


def _whole_number(text: str | None) -> int | None:
    return int(text) if text and re.fullmatch(r"[0-9]{1,18}", text) else None


def _fields(stream: io.BufferedIOBase) -> dict[str, str] | None:
    """Header fields of the next record, by lower-case name; None at the end of the archive."""
    line = stream.readline()
    while line in (b"\r\n", b"\n"):
        line = stream.readline()
    if not line:
        return None
    if not line.startswith(b"WARC/"):
        raise _Damaged("not_warc")
    fields = {}
    while True:
        line = stream.readline()
        if not line.endswith(b"\n"):
            raise _Damaged("truncated")
        if not line.strip():
            return fields
        name, _, value = line.decode("utf-8", "replace").partition(":")
        fields[name.strip().lower()] = value.strip()


def parse_archive(content: bytes) -> Iterator[dict]:
    """The records of an archive, compressed or not. Where it breaks off, the last row has a status and no block."""
    packed = content[:2] == b"\x1f\x8b"
    stream = io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(content))) if packed else io.BytesIO(content)
    bare = {n.split()[0]: None for n in _SEGMENT.split(", ")}
    while True:
        row = dict(bare)
        try:
            if (fields := _fields(stream)) is None:
                return
            row |= {
                "record_id": fields.get("warc-record-id", "").strip("<>") or None,
                "record_type": fields.get("warc-type"),
                "target_uri": fields.get("warc-target-uri"),
                "label": fields.get("record-label"),
                "payload_digest": fields.get("warc-payload-digest"),
                "refers_to": fields.get("warc-refers-to", "").strip("<>") or None,
                "segment": _whole_number(fields.get("warc-segment-number")),
                "total_length": _whole_number(fields.get("warc-segment-total-length")),
            }
            if row["record_type"] == "continuation":
                row["record_id"] = fields.get("warc-segment-origin-id", "").strip("<>") or None
            length = _whole_number(fields.get("content-length"))
            if length is None:
                raise _Damaged("truncated")
            row["block"] = stream.read(length)
            if len(row["block"]) < length:
                raise _Damaged("truncated")
        except (_Damaged, OSError, EOFError, zlib.error) as problem:
            status = str(problem) if isinstance(problem, _Damaged) else "truncated"
            yield row | {"status": status, "block": None}
            return
        yield row | {"status": "ok"}


def _decode(row: dict, block: bytes | None, status: str) -> dict:
    """A record with its payload; revisits have none."""
    payload = None
    if status == "ok" and row["record_type"] == "response":
        payload, status = http_payload(block)
        algorithm, _, value = (row["payload_digest"] or "").partition(":")
        if payload is not None and algorithm == "sha256" and value != hashlib.sha256(payload).hexdigest():
            status = "bad_digest"
    return row | {"payload": payload, "status": status}


class _Out:
    """Decoded rows on their way to an Arrow batch."""

    def __init__(self, schema: str):
        kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
        self.schema = pa.schema([(n, kinds[k]) for n, k in (f.split() for f in schema.split(", "))])
        self.rows, self.held = [], 0

    def add(self, row: dict) -> bool:
        """True if the batch is full."""
        self.rows.append({n: row.get(n) for n in self.schema.names})
        self.held += 300 + len(row.get("payload") or row.get("block") or b"")
        return self.held > BATCH_BYTES

    def batch(self) -> pa.RecordBatch:
        out = pa.RecordBatch.from_pylist(self.rows, self.schema)
        self.rows, self.held = [], 0
        return out


def _read(batches: Iterator[pa.RecordBatch], segments: bool) -> Iterator[pa.RecordBatch]:
    """The segments of archives, or their whole records, decoded. Of other record types only these two are read."""
    out = _Out(_SEGMENT if segments else _DECODED)
    for batch in batches:
        for content in batch.column(0):
            for row in parse_archive(content.as_py()):
                if row["record_type"] not in ("response", "revisit", "continuation") and row["status"] == "ok":
                    continue
                part = row["record_type"] == "continuation" or row["segment"] is not None
                if part != segments:
                    continue
                if out.add(row if segments else _decode(row, row["block"], row["status"])):
                    yield out.batch()
    yield out.batch()


def join_segments(parts: list[dict]) -> tuple[dict, bytes | None, str]:
    """(first segment, block, status) of the segments of one record, in order."""
    head = next((p for p in parts if p["record_type"] != "continuation"), None)
    row = head or parts[0]
    if broken := [p["status"] for p in parts if p["status"] != "ok"]:
        return row, None, broken[0]
    # An archive that was copied brings its segments again.
    single = {}
    for p in parts:
        if single.setdefault(p["segment"], p)["block"] != p["block"]:
            return row, None, "conflict"
    numbers = sorted(n for n in single if n is not None)
    if head is None or None in single or numbers != list(range(1, len(numbers) + 1)):
        return row, None, "missing_segment"
    block = b"".join(single[n]["block"] for n in numbers)
    total = single[numbers[-1]]["total_length"]
    if total is None:
        return row, None, "missing_segment"
    return row, block, "ok" if total == len(block) else "wrong_length"


def _reassemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come ordered by record and segment; one record is held at a time."""
    out, parts = _Out(_DECODED), []

    def done() -> bool:
        row, block, status = join_segments(parts)
        return out.add(_decode(row, block, status))

    for batch in batches:
        for values in zip(*batch.columns):
            part = {name: value.as_py() for name, value in zip(batch.schema.names, values)}
            if parts and part["record_id"] != parts[0]["record_id"]:
                if done():
                    yield out.batch()
                parts = []
            parts.append(part)
    if parts:
        done()
    yield out.batch()


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """(record_id, record_type, target_uri, label, payload_digest, refers_to, status, payload): records, put together.

    One row per response and revisit; revisits have no payload of their own. ``status``: ``ok``, ``missing_segment``,
    ``wrong_length``, ``conflict`` (two segments of one number), ``bad_framing``, ``bad_digest``, ``truncated`` (the archive breaks
    off) or ``not_warc``; all but ``ok`` and ``bad_digest`` have no payload. An archive is read as one value, so archives of others
    should hold some hundred MB at most; those written here do.
    """
    archives = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("content")
    whole = archives.mapInArrow(partial(_read, segments=False), _DECODED)
    parts = archives.mapInArrow(partial(_read, segments=True), _SEGMENT)
    parts = parts.repartition("record_id").sortWithinPartitions("record_id", "segment")
    return whole.unionByName(parts.mapInArrow(_reassemble, _DECODED))


def follow_revisits(records: DataFrame) -> DataFrame:
    """(record_id, record_type, label, refers_to_label, payload_bytes, payload_digest, status): full payloads measured.

    A revisit has the size and the digest of the record it refers to; ``no_origin`` if that is absent or if the digests
    differ. Payloads are measured where they are read and go no further; many revisits may share an origin.
    """
    measured = materialize(
        records.select(
            "record_id", "record_type", "label", "refers_to", "status", F.col("payload_digest").alias("_claimed"),
            F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha2("payload", 256).alias("payload_digest"),
        )
    )
    columns = ["record_id", "record_type", "label", "refers_to_label", "payload_bytes", "payload_digest", "status"]
    held = measured.filter("record_type <> 'revisit' or record_type is null").withColumn("refers_to_label", F.lit(None).cast("string"))
    origins = measured.filter("record_type = 'response' and status = 'ok'").groupBy(F.col("record_id").alias("refers_to"))
    origins = origins.agg(*[F.min(c).alias(c) for c in ("payload_bytes", "payload_digest")], F.min("label").alias("refers_to_label"))
    revisits = measured.filter("record_type = 'revisit'").drop("payload_bytes", "payload_digest")
    joined = skew_join(revisits, origins, ["refers_to"], "left", spread_by="record_id")
    fits = F.coalesce(F.concat(F.lit("sha256:"), F.col("payload_digest")) == F.col("_claimed"), F.lit(False))
    status = F.when(F.col("status") != "ok", F.col("status")).when(fits, "ok").otherwise("no_origin")
    return held.select(*columns).unionByName(joined.withColumn("status", status).select(*columns))


def _urn(key: Column) -> Column:
    h = F.md5(key)
    cuts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat(F.lit("urn:uuid:"), F.concat_ws("-", *[F.substring(h, a, n) for a, n in cuts]))


def page_records(pages: DataFrame, *, id_col: str = "page_id", uri_col: str = "url", html_col: str = "html") -> DataFrame:
    """Records for ``write_archives``, one per page; the label is the page's id.

    Of pages with equal payloads of ``LEAST_REVISIT`` bytes or more the one with the least id (missing ids last) is the
    response, and others revisit it; of equal ids, one of them is. Smaller payloads are all responses. A missing page is empty.
    Rows that repeat in full are records of their own. Other columns are ignored.
    """
    text = F.coalesce(F.col(f"`{html_col}`"), F.lit("")).cast("binary")
    base = pages.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{uri_col}`").alias("target_uri"), text.alias("payload"))
    base = base.withColumn("payload_digest", F.sha2("payload", 256))
    named = F.to_json(F.struct("_id", "target_uri", "payload_digest"), {"ignoreNullFields": "false"})
    base = base.withColumn("_key", F.md5(named))
    each = ["_id", "payload_digest"]
    keys = base.groupBy("_key", *each, F.octet_length("payload").alias("_bytes")).agg(F.count(F.lit(1)).alias("_n"))
    keys = materialize(keys)
    same = keys.filter(F.col("_bytes") >= LEAST_REVISIT).groupBy("payload_digest")
    same = same.agg(F.min(F.struct(F.col("_id").isNull(), "_id", "_key")).alias("_first"), F.sum("_n").alias("_pages"))
    same = same.filter("_pages > 1").select("payload_digest", F.col("_first._key").alias("_first"))
    repeated = keys.filter("_n > 1").select("_key", "_n")
    base = base.withColumn("_copy", F.lit(0).cast("long"))
    if not repeated.isEmpty():
        once = lookup_join(base.drop("_copy"), repeated, ["_key"], "inner", spread_by="_id").dropDuplicates(["_key"])
        copies = once.withColumn("_copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1))).drop("_n")
        base = base.join(repeated, "_key", "left_anti").unionByName(copies)
    joined = lookup_join(base, same, ["payload_digest"], "left", spread_by="_key")
    held = F.col("_first").isNull() | ((F.col("_first") == F.col("_key")) & (F.col("_copy") == 0))
    return joined.select(
        _urn(F.concat("_key", F.lit(":"), "_copy")).alias("record_id"),
        F.when(held, "response").otherwise("revisit").alias("record_type"),
        "target_uri",
        F.col("_id").cast("string").alias("label"),
        F.when(held, F.col("payload")).alias("payload"),
        "payload_digest",
        F.when(~held, _urn(F.concat("_first", F.lit(":0")))).alias("refers_to"),
    )
