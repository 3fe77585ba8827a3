"""A dictionary-compressed WARC writer, and the reader of what it writes.

A Zstandard dictionary is built from a bounded sample of the records to archive (``SAMPLE`` payloads of
at most ``SAMPLE_BYTES`` each, by the order of a hash). Every archive file starts with a skippable frame
that holds the dictionary, followed by one compressed frame per record, a warcinfo first, so each record can
be read alone. Tasks write files of about ``ROLL`` bytes into the cluster's shared folder under names of their
own; the list of files that succeeded is itself a written table, so a task that runs twice leaves an unused
file and no repeated record. Reading opens the files of that list.

Of records with equal payloads of at least 100 bytes the one with the smallest page_id is a response and
holds the payload, as an HTTP message; the others are revisits that name it and carry length and digest of the
full payload. Which record that is comes from a grouped minimum over digests on rows without payloads. Only
repeated digests matter then: other pages are written from where they are read, revisits are decided without their
payloads, and the payloads of the first of each group alone are shuffled. Two broadcast tables of at most ``MARKS``
hashes sort rows out beforehand; how full they are changes the traffic and not the result.

Defined cases: null html is an empty payload; rows that repeat the smallest page_id are responses too; null
page_ids sort last, and a group of them alone has responses only; a null url stays null, and any other comes back
as it was; an empty table gives an empty result; other columns are left out.
"""

from __future__ import annotations

import datetime
import hashlib
import json
import struct
import urllib.parse
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, shared_dir

#: Fixed values of the format.
SKIPPABLE, FRAME = 0x184D2A5D, b"\x28\xb5\x2f\xfd"
LEAST_REVISIT = 100
SAMPLE, SAMPLE_BYTES, DICT_BYTES = 400, 65_536, 65_536
ROLL, MOST_TASKS = 32 << 20, 50_000
MARKS = 1 << 21
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"


def _mark(*names: str):
    return F.pmod(F.xxhash64(*names), F.lit(MARKS)).cast("int")


def records(pages: DataFrame) -> DataFrame:
    """page_id, url, payload (null for revisits), payload_bytes, payload_digest, record_type, refers_to."""
    body = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", body.alias("payload")).withColumns(
        {"payload_bytes": F.octet_length("payload").cast("long"), "payload_digest": F.sha2("payload", 256)}
    )
    narrow = materialize(rows.drop("payload"))
    large = F.col("payload_bytes") >= LEAST_REVISIT
    firsts = narrow.where(large).groupBy("payload_digest").agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
    firsts = materialize(firsts.where("n > 1 and first_id is not null").select(F.col("payload_digest").alias("f_digest"), "first_id"))
    known = F.col("payload_digest") == F.col("f_digest")
    marks = F.broadcast(firsts.select(_mark("f_digest").alias("mark")).distinct())
    hit = _mark("payload_digest") == F.col("mark")
    # of groups: who is a revisit, and which rows still need their payloads
    decided = narrow.join(marks, hit, "left_semi").join(firsts, known, "left")
    again = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id")) & large
    revisits = decided.where(again).select("page_id", "url", F.lit(None).cast("binary").alias("payload"), "payload_bytes", "payload_digest", F.lit("revisit").alias("record_type"), F.col("first_id").alias("refers_to"))
    keys = materialize(decided.where(~again).select(F.col("page_id").alias("k_id"), F.col("payload_digest").alias("k_digest")).distinct())
    own = F.broadcast(keys.select(_mark("k_id", "k_digest").alias("own")).distinct())
    whole = rows.join(marks, hit, "left_semi").join(own, _mark("page_id", "payload_digest") == F.col("own"), "left_semi")
    whole = whole.join(keys, F.col("page_id").eqNullSafe(F.col("k_id")) & (F.col("payload_digest") == F.col("k_digest")), "left_semi")
    response = lambda df: df.select("page_id", "url", "payload", "payload_bytes", "payload_digest", F.lit("response").alias("record_type"), F.lit(None).cast("long").alias("refers_to"))
    return response(rows.join(marks, hit, "left_anti")).unionByName(response(whole)).unionByName(revisits)


def train_dictionary(pages: DataFrame) -> bytes:
    """From a bounded sample; empty if there is too little to learn from."""
    rows = pages.where((F.octet_length("html") <= SAMPLE_BYTES) & (F.octet_length("html") >= 64)).select("page_id", F.xxhash64("page_id", "url").alias("h"))
    ids = [r.page_id for r in rows.orderBy("h", "page_id").limit(SAMPLE).collect()]
    chosen = pages.where(F.col("page_id").isin(ids) & (F.octet_length("html") <= SAMPLE_BYTES)) if ids else pages.limit(0)
    samples = sorted(r.html.encode("utf-8", "surrogatepass") for r in chosen.select("page_id", "html").dropDuplicates(["page_id"]).limit(SAMPLE).collect())
    try:
        return zstandard.train_dictionary(DICT_BYTES, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b""


def record_id(page_id: int | None, digest: str) -> str:
    """The same for a record whenever it is named, so that a revisit can refer to a record of another file."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{digest}')}>"


def record_bytes(row: dict, date: str) -> bytes:
    response, digest = row["record_type"] == "response", row["payload_digest"]
    block = HTTP.format(row["payload_bytes"]).encode() + row["payload"] if response else b""
    head = ["WARC/1.1", f"WARC-Type: {row['record_type']}", f"WARC-Date: {date}"]
    head += [f"WARC-Record-ID: {record_id(row['page_id'], digest) if response else f'<urn:uuid:{uuid.uuid4()}>'}"]
    if row["url"]:
        head.append("WARC-Target-URI: " + urllib.parse.quote(row["url"].encode("utf-8", "surrogatepass"), safe=":/?#[]@!$&'()*+,;=%-._~"))
    head += [f"WARC-Payload-Digest: sha256:{digest}", f"X-Payload-Length: {row['payload_bytes']}", f"X-Page: {json.dumps([row['page_id'], row['url'], row['refers_to']])}"]
    if not response:
        head += [f"WARC-Profile: {REVISIT}", f"WARC-Refers-To: {record_id(row['refers_to'], digest)}"]
    kind = "application/http; msgtype=response"
    return "\r\n".join([*head, f"Content-Type: {kind}", f"Content-Length: {len(block)}", "", ""]).encode() + block + b"\r\n\r\n"


def info_bytes(date: str, name: str) -> bytes:
    block = b"software: loomgraph\r\nformat: WARC File Format 1.1\r\n"
    head = ["WARC/1.1", "WARC-Type: warcinfo", f"WARC-Date: {date}", f"WARC-Record-ID: <urn:uuid:{uuid.uuid4()}>", f"WARC-Filename: {name}", "Content-Type: application/warc-fields", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(head).encode() + block + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """The fields of a record and its block."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = {}
    for line in head.decode("utf-8", "surrogatepass").split("\r\n")[1:]:
        name, _, value = line.partition(":")
        fields[name.strip()] = value.strip()
    return fields, rest[: int(fields["Content-Length"])]


def payload_of(fields: dict[str, str], block: bytes) -> bytes:
    """Of an HTTP message what follows its head; of another record the block."""
    return block.partition(b"\r\n\r\n")[2] if fields.get("Content-Type", "").startswith("application/http") else block


def leading_frame(dictionary: bytes) -> bytes:
    return struct.pack("<II", SKIPPABLE, len(dictionary)) + dictionary


def write(rows: DataFrame, dictionary: bytes, folder: str) -> DataFrame:
    """Write the records and return the files: path, n_records, n_bytes."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        known = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        pack = zstandard.ZstdCompressor(level=6, dict_data=known, write_content_size=True)
        name, out, n, size = "", None, 0, 0
        now = lambda: datetime.datetime.now(datetime.UTC).strftime("%Y-%m-%dT%H:%M:%SZ")

        def close() -> pa.RecordBatch:
            out.close()
            return pa.RecordBatch.from_pydict({"path": pa.array([name]), "n_records": pa.array([n], pa.int64()), "n_bytes": pa.array([size], pa.int64())})

        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    name, n, size = f"{base}/{uuid.uuid4().hex}.warc.zst", 0, 0
                    out = store.open_output_stream(name, compression=None)
                    for part in (leading_frame(dictionary), pack.compress(info_bytes(now(), name.rsplit("/", 1)[-1]))):
                        out.write(part)
                        size += len(part)
                out.write(frame := pack.compress(record_bytes(row, now())))
                size += len(frame)
                n += 1
                if size >= ROLL:
                    yield close()
                    out = None
        if out is not None:
            yield close()

    return materialize(rows.mapInArrow(run, "path string, n_records long, n_bytes long"))


def read_frames(stream, chunk: int = 1 << 20) -> Iterator[bytes]:
    """The records of an archive, one frame at a time, whatever the size of the file."""
    rest = stream.read(8)
    if len(rest) < 8:
        return
    magic, n = struct.unpack("<II", rest)
    dictionary = b""
    if magic == SKIPPABLE:  # an archive of another writer may have none
        dictionary, rest = stream.read(n), b""
    known = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary)) if dictionary else zstandard.ZstdDecompressor()
    while True:
        rest = rest or stream.read(chunk)
        if not rest:
            return
        one, parts = known.decompressobj(), []
        while not one.eof:
            if not rest:
                rest = stream.read(chunk)
                if not rest:
                    raise ValueError("an archive ends within a record")
            parts.append(one.decompress(rest))
            rest = one.unused_data if one.eof else b""
        yield b"".join(parts)


def read(files: DataFrame, folder: str) -> DataFrame:
    """One row per response or revisit of the archives: page_id, payload_bytes, payload_digest, record_type, refers_to,
    url. Length and digest of a response are those of the payload read; it must be the one declared. Archives of other
    writers have no page_id, and their url is the record's."""
    schema = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("url", pa.string())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows = []
                with store.open_input_stream(path, compression=None) as stream:
                    for data in read_frames(stream):
                        head, block = parse_record(data)
                        kind = head["WARC-Type"]
                        if kind not in ("response", "revisit"):
                            continue
                        page_id, url, refers_to = json.loads(head["X-Page"]) if "X-Page" in head else (None, head.get("WARC-Target-URI"), None)
                        declared = head.get("WARC-Payload-Digest", "").removeprefix("sha256:")
                        size, digest = int(head.get("X-Payload-Length", 0)), declared
                        if kind == "response":
                            body = payload_of(head, block)
                            size, digest = len(body), hashlib.sha256(body).hexdigest()
                            if declared not in ("", digest) and "X-Page" in head:
                                raise ValueError(f"{path}: a payload differs from its digest")
                        rows.append((page_id, size, digest, kind, refers_to, url))
                        if len(rows) >= 10_000:
                            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
                            rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    # a task per file or so: left to itself, Spark would judge the work by the few bytes of the list
    tasks = max(1, min(files.count(), MOST_TASKS))
    return files.select("path").repartition(tasks).mapInArrow(run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string")


def archive(pages: DataFrame) -> DataFrame:
    """Write ``pages`` and read the archives back."""
    folder = shared_dir(pages.sparkSession)
    uri = folder if "://" in folder or not folder.startswith("file:") else "file://" + folder.removeprefix("file:")
    return read(write(records(pages), train_dictionary(pages), uri), uri)


SQL = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest, url FROM pages),
f AS (SELECT payload_digest, min(page_id) AS first_id FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT page_id, payload_bytes, p.payload_digest, CASE WHEN page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to, url
FROM p LEFT JOIN f ON p.payload_digest = f.payload_digest
"""
