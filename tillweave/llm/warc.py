"""WARC archives: write with segments, chunked framing and revisits, read back and reassemble.

Writing: a response's block is an HTTP message in chunked framing; blocks longer than SEGMENT
bytes become a first record and continuation records that name it as origin, number themselves and
end with the total length. Pages whose payload of MIN_REVISIT bytes or more occurs again
(the one with the largest page_id stays) become revisit records. Spark's text writer puts records
into gzip files in the shared folder, the record separator of the format being its line separator.

Reading: archives are parsed by their Content-Length, continuation records are grouped by origin,
ordered by segment number, checked against the total length, and the chunked framing is undone.
Damage raises an error.

Defined results: null html is an empty payload, a null url is about:blank; a null page_id is kept
and never another's origin while a numbered page has the payload; rows that repeat the largest page_id are all responses;
an empty table gives no rows; extra columns are left out.
"""

from __future__ import annotations

import gzip
import hashlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillweave.llm.shared import need, scratch, settled, ship

ship(__name__)

SEGMENT, CHUNK, MIN_REVISIT = 8192, 4096, 1000
#: Bounds a file to RECORDS * SEGMENT bytes before compression, headers aside.
RECORDS = 1024
BREAK = b"\r\n\r\n"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"


def parts(data: bytes, most: int) -> list[bytes]:
    """data in runs of at most `most` bytes that end between characters."""
    out, i = [], 0
    while i < len(data):
        j = min(i + most, len(data))
        while j < len(data) and j > i + 1 and data[j] & 0xC0 == 0x80:
            j -= 1
        out.append(data[i:j])
        i = j
    return out


def chunked(payload: bytes) -> bytes:
    return b"".join(b"%x\r\n%b\r\n" % (len(p), p) for p in parts(payload, CHUNK)) + b"0\r\n\r\n"


def unchunked(body: bytes) -> bytes:
    out, i = [], 0
    while True:
        j = body.index(b"\r\n", i)
        n = int(body[i:j].split(b";")[0], 16)
        if n == 0:
            return b"".join(out)
        out.append(body[j + 2 : j + 2 + n])
        if len(out[-1]) != n or body[j + 2 + n : j + 4 + n] != b"\r\n":
            raise ValueError("broken chunk")
        i = j + 4 + n


def record(headers: list[tuple[str, object]], block: bytes) -> bytes:
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in headers if v is not None), f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + BREAK + block


def records(row: dict, name: str) -> list[bytes]:
    """A page's records, in order; name makes the ids unique."""
    uri = (row["url"] or "about:blank").replace("\r", "%0D").replace("\n", "%0A")
    base = [("WARC-Target-URI", uri), ("WARC-Date", "2024-01-01T00:00:00Z"), ("X-Page-ID", row["page_id"]), ("WARC-Payload-Digest", f"sha1:{row['digest']}")]
    me = f"<urn:page:{row['page_id']}:{name}>"
    if row["keeper"] is not None:
        profile = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        head = [("WARC-Type", "revisit"), ("WARC-Record-ID", me), ("WARC-Refers-To", f"<urn:page:{row['keeper']}>"), ("WARC-Profile", profile)]
        return [record(head + base, HTTP)]
    block = HTTP + chunked(row["payload"].encode())
    cut = parts(block, SEGMENT)
    first = [("WARC-Type", "response"), ("WARC-Record-ID", me), ("Content-Type", "application/http; msgtype=response"), ("WARC-Segment-Number", 1 if len(cut) > 1 else None)]
    out = [record(first + base, cut[0])]
    for k, piece in enumerate(cut[1:], 2):
        total = len(block) if k == len(cut) else None
        head = [("WARC-Type", "continuation"), ("WARC-Record-ID", f"{me[:-1]}:{k}>"), ("WARC-Segment-Origin-ID", me), ("WARC-Segment-Number", k), ("WARC-Segment-Total-Length", total)]
        out.append(record(head + base[:2], piece))
    return out


def _write_batches(batches):
    part, n = TaskContext.get().partitionId(), 0
    for batch in batches:
        out, held = [], 0
        for i in range(batch.num_rows):
            row = {k: batch.column(k)[i].as_py() for k in batch.schema.names}
            made = records(row, f"{part}-{n}")
            n += 1
            out += made
            held += sum(map(len, made))
            if held > 4 << 20:
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary()).cast(pa.string())], ["value"])
                out, held = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary()).cast(pa.string())], ["value"])


def write(pages: DataFrame, path: str) -> None:
    """Write an archive folder. The larger payload table is dealt once, by digest, for the revisits."""
    need(pages, "page_id", "url", "html")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("payload"))
    rows = rows.withColumn("digest", F.sha1(F.col("payload").cast("binary")))
    large = rows.filter(F.octet_length("payload") >= MIN_REVISIT)
    keep = large.groupBy("digest").agg(F.max("page_id").alias("keeper"), F.count("*").alias("n")).filter("n > 1 and keeper is not null").drop("n")
    both = rows.join(keep, "digest", "left")
    both = both.withColumn("keeper", F.when(~F.col("page_id").eqNullSafe(F.col("keeper")), F.col("keeper")))
    text = both.mapInArrow(_write_batches, "value string")
    text.write.option("lineSep", BREAK.decode()).option("compression", "gzip").option("maxRecordsPerFile", RECORDS).text(path)


RECORD = "kind string, id string, origin string, number int, total long, page_id long, refers_to long, digest string, block binary"


def parse(data: bytes):
    """Tuples of RECORD of an archive's bytes."""
    i = 0
    while i < len(data):
        j = data.index(BREAK, i)
        head = dict(line.split(": ", 1) for line in data[i:j].decode().split("\r\n")[1:])
        n = int(head["Content-Length"])
        block = data[j + 4 : j + 4 + n]
        if len(block) != n or data[j + 4 + n : j + 8 + n] != BREAK:
            raise ValueError("a record is longer or shorter than its Content-Length")
        i = j + 8 + n
        number = lambda key, cut=None: int(head[key].strip("<>").split(":")[-1]) if key in head and head[key] != "None" else None
        yield (head["WARC-Type"], head["WARC-Record-ID"], head.get("WARC-Segment-Origin-ID", head["WARC-Record-ID"]), number("WARC-Segment-Number"),
               number("WARC-Segment-Total-Length"), number("X-Page-ID"), number("WARC-Refers-To"), head.get("WARC-Payload-Digest", "")[5:], block)


def _read_batches(batches):
    schema = pa.schema([("kind", pa.string()), ("id", pa.string()), ("origin", pa.string()), ("number", pa.int32()), ("total", pa.int64()),
                        ("page_id", pa.int64()), ("refers_to", pa.int64()), ("digest", pa.string()), ("block", pa.binary())])
    for batch in batches:
        for content in batch.column("content"):
            out, held = [], 0
            for r in parse(gzip.decompress(content.as_buffer())):
                out.append(r)
                held += len(r[8])
                if held > 4 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), schema.types, strict=True)], schema=schema)
                    out, held = [], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), schema.types, strict=True)], schema=schema)


def reassemble(found: DataFrame) -> DataFrame:
    """One row per original record: kind, page_id, refers_to, digest, block. Whole records pass as they are."""
    alone = found.filter("number is null").select("kind", "page_id", "refers_to", "digest", "block")
    cut = found.filter("number is not null").groupBy("origin").agg(
        F.sort_array(F.collect_list(F.struct("number", "block"))).alias("s"),
        F.max("total").alias("total"),
        *(F.max_by(c, F.when(F.col("number") == 1, 1)).alias(c) for c in ("kind", "page_id", "refers_to", "digest")),
    )
    text = F.array_join(F.transform("s", lambda x: x["block"].cast("string")), "")
    right = (F.octet_length(text) == F.col("total")) & (F.col("s")[0]["number"] == 1) & (F.element_at("s", -1)["number"] == F.size("s"))
    block = F.when(right, text.cast("binary")).otherwise(F.raise_error(F.concat(F.lit("segments missing of "), F.col("origin"))).cast("binary"))
    return alone.unionByName(cut.select("kind", "page_id", "refers_to", "digest", block.alias("block")))


def _payload_batches(batches):
    for batch in batches:
        size, sha = [], []
        for kind, digest, block in zip(batch.column("kind").to_pylist(), batch.column("digest").to_pylist(), batch.column("block"), strict=True):
            if kind == "revisit":
                size.append(None), sha.append(digest)
                continue
            data = block.as_py()
            payload = unchunked(data[data.index(BREAK) + 4 :])
            size.append(len(payload)), sha.append(hashlib.sha1(payload).hexdigest())
            if sha[-1] != digest:
                raise ValueError("payload digest differs")
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("kind", "page_id", "refers_to")), pa.array(sha, pa.string()), pa.array(size, pa.int64())], ["kind", "page_id", "refers_to", "digest", "size"])


def read(spark, path: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every record of an archive."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    whole = reassemble(files.mapInArrow(_read_batches, RECORD))
    rows = settled(whole.mapInArrow(_payload_batches, "kind string, page_id long, refers_to long, digest string, size long"))
    kept = rows.filter("kind = 'response' and page_id is not null").select(F.col("page_id").alias("kept_id"), F.col("size").alias("kept_size"), F.col("digest").alias("kept_digest"))
    kept = kept.dropDuplicates(["kept_id", "kept_digest"])
    both = rows.join(kept, (F.col("kind") == "revisit") & (F.col("refers_to") == F.col("kept_id")) & (F.col("digest") == F.col("kept_digest")), "left")
    return both.select("page_id", F.coalesce("size", "kept_size").alias("payload_bytes"), F.col("digest").alias("payload_digest"), F.col("kind").alias("record_type"), "refers_to")


def round_trip(pages: DataFrame) -> DataFrame:
    path = scratch(pages.sparkSession) + "/archive"
    write(pages, path)
    return read(pages.sparkSession, path)
