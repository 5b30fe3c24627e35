"""WARC archives with a two-level capture index.

Writing: each task packs its pages into an archive of its own, one gzip member per record.
Pages with equal payloads of at least ``REVISIT_BYTES`` are stored once, as the response with
the smallest id; the others become revisit records that refer to it.

Index: captures are sorted by reversed-host key and id, in ranges. Each range is a shard: a
file of compressed blocks of ``BLOCK_LINES`` sorted lines, and a sparse directory with first
key, offset and length of each block. A small manifest has each shard's first and last key.

Lookup: a key's shards are found by binary search in the manifest, its blocks by binary search
in the shard's directory, its lines by binary search in the block, and the records by range
reads. Work is dealt by block and by archive range, so a key with very many captures is
spread over its blocks.

Every attempt of a task writes new files; what counts is only what the rows returned by the
successful attempt point to, and these rows are stored at once. Lost executors leave files
that nothing refers to.

Defined results: a null payload is empty; null URLs share the empty key; rows with a null id
are never the smallest unless all are null (then there is no revisit); repeated rows are
repeated records, all with their own line in the index. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from triplewright.llm.files import RangeReader, open_fs
from triplewright.session import materialize, scratch_path

REVISIT_BYTES = 100
BLOCK_LINES = 1000
# Consecutive bytes of an archive read by one task.
RANGE_BYTES = 8 << 20
DATE = "2024-01-01T00:00:00Z"
_ENTRY = "key string, page_id long, archive string, start long, length long"
_RECORD = "page_id long, url string, record_type string, refers_to long, payload binary, payload_bytes long, payload_digest string"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def url_key(url: Column) -> Column:
    """Reversed host, closing bracket, path and query: ``com,example,www)/a?b``. Empty for null.

    Scheme, user, port and fragment are left out; control characters are escaped.
    """
    rest = F.regexp_replace(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.\-]*://", "")
    host = F.lower(F.regexp_replace(F.regexp_extract(rest, r"^([^/?#]*)", 1), r"^[^@]*@|:[0-9]*$", ""))
    path = F.regexp_replace(F.regexp_replace(rest, r"^[^/?#]*", ""), r"#[\s\S]*$", "")
    labels = F.array_join(F.reverse(F.split(host, r"\.", -1)), ",")
    key = F.concat(labels, F.lit(")"), F.when(path.startswith("/"), path).otherwise(F.concat(F.lit("/"), path)))
    for plain, escaped in (("\t", "%09"), ("\n", "%0A"), ("\r", "%0D")):
        key = F.replace(key, F.lit(plain), F.lit(escaped))
    return F.when(url.isNull(), F.lit("")).otherwise(key)


def with_revisits(pages: DataFrame) -> DataFrame:
    """(page_id, url, payload, digest, refers_to): refers_to is null for responses.

    Only digests of several pages take part in the join; copies of one payload are split
    over tasks by adaptive execution.
    """
    payload = F.encode(F.coalesce(F.col("html"), F.lit("")), "UTF-8")
    rows = pages.select("page_id", "url", payload.alias("payload")).withColumn("digest", F.sha2("payload", 256))
    first = F.min("page_id").alias("first_id")
    several = (
        rows.filter(F.octet_length("payload") >= REVISIT_BYTES)
        .groupBy("digest")
        .agg(first, F.max("page_id").alias("last_id"), F.count("*").alias("n"), F.count("page_id").alias("n_ids"))
        .filter("n_ids > 0 AND (first_id < last_id OR n_ids < n)")
        .select("digest", "first_id")
    )
    is_revisit = F.col("first_id").isNotNull() & (F.col("page_id").isNull() | (F.col("page_id") > F.col("first_id")))
    joined = rows.join(several, "digest", "left")
    return joined.withColumn("refers_to", F.when(is_revisit, F.col("first_id"))).drop("first_id")


def _urn(page_id: int | None) -> str:
    return f"<urn:x-page:{'' if page_id is None else page_id}>"


def _from_urn(urn: str | None) -> int | None:
    number = (urn or "").removeprefix("<urn:x-page:").removesuffix(">")
    return int(number) if number else None


def record_bytes(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One uncompressed WARC record."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    fields = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {_urn(page_id)}",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha256:{digest}",
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        fields.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if refers_to is not None:
        fields += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: {_urn(refers_to)}"]
    return "\r\n".join(fields).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")[1:]
    return {name.lower(): value for name, _, value in (line.partition(": ") for line in lines)}


def parse_record(data: bytes) -> dict:
    """The capture in one uncompressed record; the payload is null for revisits."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = _fields(head)
    block = rest[: int(fields["content-length"])]
    http, _, body = block.partition(b"\r\n\r\n")
    kind = fields["warc-type"]
    digest = fields["warc-payload-digest"].removeprefix("sha256:")
    size = int(_fields(http)["content-length"])
    if kind == "response" and (len(body) != size or hashlib.sha256(body).hexdigest() != digest):
        raise ValueError(f"damaged record {fields['warc-record-id']}")
    return {
        "page_id": _from_urn(fields["warc-record-id"]),
        "url": fields.get("warc-target-uri"),
        "record_type": kind,
        "refers_to": _from_urn(fields.get("warc-refers-to")),
        "payload": body if kind == "response" else None,
        "payload_bytes": size,
        "payload_digest": digest,
    }


def write_archives(captures: DataFrame, folder: str) -> DataFrame:
    """Write (page_id, url, payload, digest, refers_to) as archives; returns stored index entries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, at, uri = None, 0, f"{folder}/{uuid.uuid4().hex}.warc.gz"
        try:
            for batch in batches:
                rows = batch.to_pydict()
                starts, lengths = [], []
                for page_id, url, payload, digest, refers_to in zip(
                    rows["page_id"], rows["url"], rows["payload"], rows["digest"], rows["refers_to"]
                ):
                    if out is None:
                        system, path = open_fs(uri)
                        system.create_dir(path.rpartition("/")[0], recursive=True)
                        out = system.open_output_stream(path, compression=None)
                    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
                    member = packer.compress(record_bytes(page_id, url, payload, digest, refers_to)) + packer.flush()
                    out.write(member)
                    starts.append(at)
                    lengths.append(len(member))
                    at += len(member)
                n = batch.num_rows
                yield pa.RecordBatch.from_arrays(
                    [batch.column("key"), batch.column("page_id"), pa.array([uri] * n, pa.string()), pa.array(starts, pa.int64()), pa.array(lengths, pa.int64())],
                    names=["key", "page_id", "archive", "start", "length"],
                )
        finally:
            if out is not None:
                out.close()

    rows = captures.select("page_id", "url", "payload", "digest", "refers_to", url_key(F.col("url")).alias("key"))
    return materialize(rows.mapInArrow(run, _ENTRY), "captures")


@dataclass(frozen=True)
class Shard:
    """A range of the index: file of blocks, file of its directory, first and last key."""

    blocks: str
    directory: str
    first_key: bytes
    last_key: bytes


def write_index(entries: DataFrame, folder: str, block_lines: int = BLOCK_LINES) -> list[Shard]:
    """Sort the entries into shards; returns the manifest, one entry per shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = f"{folder}/{uuid.uuid4().hex}"
        out, at, lines, directory, first, last = None, 0, [], [], None, None

        def flush() -> None:
            nonlocal at
            block = zlib.compress(b"\n".join(line for _, line in lines), 6)
            directory.append(b"%s\t%d\t%d" % (lines[0][0], at, len(block)))
            out.write(block)
            at += len(block)
            lines.clear()

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("key", "page_id", "archive", "start", "length")]
            for key, page_id, archive, start, length in zip(*columns):
                if out is None:
                    system, path = open_fs(f"{name}.cdx")
                    system.create_dir(path.rpartition("/")[0], recursive=True)
                    out = system.open_output_stream(path, compression=None)
                raw = key.encode("utf-8", "surrogatepass")
                first, last = raw if first is None else first, raw
                number = "" if page_id is None else page_id
                lines.append((raw, raw + f"\t{number}\t{archive}\t{start}\t{length}".encode()))
                if len(lines) == block_lines:
                    flush()
        if out is None:
            return
        if lines:
            flush()
        out.close()
        system, path = open_fs(f"{name}.dir")
        with system.open_output_stream(path, compression=None) as table:
            table.write(zlib.compress(b"\n".join(directory), 6))
        yield pa.RecordBatch.from_arrays(
            [pa.array([f"{name}.cdx"]), pa.array([f"{name}.dir"]), pa.array([first], pa.binary()), pa.array([last], pa.binary())],
            names=["blocks", "directory", "first_key", "last_key"],
        )

    ranged = entries.repartitionByRange("key", "page_id", "archive", "start")
    ranged = ranged.sortWithinPartitions("key", "page_id", "archive", "start")
    manifest = materialize(
        ranged.mapInArrow(run, "blocks string, directory string, first_key binary, last_key binary"), "manifest"
    )
    rows = manifest.orderBy("first_key", "last_key").collect()
    return [Shard(r["blocks"], r["directory"], bytes(r["first_key"]), bytes(r["last_key"])) for r in rows]


@lru_cache(maxsize=16)
def _directory(uri: str) -> tuple[list[bytes], list[tuple[int, int]]]:
    """First keys, and offsets and lengths, of a shard's blocks."""
    system, path = open_fs(uri)
    with system.open_input_stream(path, compression=None) as file:
        rows = [line.rsplit(b"\t", 2) for line in zlib.decompress(file.read()).split(b"\n")]
    return [row[0] for row in rows], [(int(row[1]), int(row[2])) for row in rows]


def find_blocks(key: bytes, manifest: list[Shard]) -> Iterator[tuple[str, int, int]]:
    """(file, offset, length) of each block that may hold captures of the key."""
    at = bisect_left([shard.last_key for shard in manifest], key)
    while at < len(manifest) and manifest[at].first_key <= key:
        first_keys, places = _directory(manifest[at].directory)
        # Captures of the key may begin in the block before the first one that starts with it.
        begin = max(0, bisect_left(first_keys, key) - 1)
        for i in range(begin, bisect_right(first_keys, key)):
            yield manifest[at].blocks, *places[i]
        at += 1


def find_lines(key: bytes, lines: list[bytes], keys: list[bytes]) -> list[bytes]:
    """The lines of a block with the key."""
    return lines[bisect_left(keys, key) : bisect_right(keys, key)]


def lookup(keys: DataFrame, manifest: list[Shard]) -> DataFrame:
    """(key, page_id, archive, start, length) of all captures of distinct ``key`` values."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                (key, *place)
                for key in batch.column("key").to_pylist()
                for place in find_blocks(key.encode("utf-8", "surrogatepass"), manifest)
            ]
            yield pa.RecordBatch.from_pydict(
                {name: [row[i] for row in found] for i, name in enumerate(("key", "blocks", "start", "length"))},
                schema=pa.schema([("key", pa.string()), ("blocks", pa.string()), ("start", pa.int64()), ("length", pa.int64())]),
            )

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, current, rows, row_keys = RangeReader(), None, [], []
        for batch in batches:
            found = []
            for key, file, start, length in zip(*(batch.column(c).to_pylist() for c in ("key", "blocks", "start", "length"))):
                if current != (file, start):
                    current = file, start
                    rows = zlib.decompress(reader.read(file, start, length)).split(b"\n")
                    row_keys = [row.split(b"\t", 1)[0] for row in rows]
                for row in find_lines(key.encode("utf-8", "surrogatepass"), rows, row_keys):
                    _, page_id, archive, at, size = row.decode("utf-8", "surrogatepass").rsplit("\t", 4)
                    found.append((key, int(page_id) if page_id else None, archive, int(at), int(size)))
            yield pa.RecordBatch.from_pydict(
                {name: [row[i] for row in found] for i, name in enumerate(("key", "page_id", "archive", "start", "length"))},
                schema=pa.schema([("key", pa.string()), ("page_id", pa.int64()), ("archive", pa.string()), ("start", pa.int64()), ("length", pa.int64())]),
            )
        reader.close()

    ordered = keys.select("key").repartitionByRange("key").sortWithinPartitions("key")
    wanted = ordered.mapInArrow(blocks, "key string, blocks string, start long, length long")
    by_block = wanted.repartition("blocks", "start").sortWithinPartitions("blocks", "start", "key")
    return by_block.mapInArrow(lines, _ENTRY)


def read_records(entries: DataFrame, payloads: bool = True) -> DataFrame:
    """The records that index entries point to, by range reads in the order of each archive."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = RangeReader()
        for batch in batches:
            found = []
            for archive, start, length in zip(*(batch.column(c).to_pylist() for c in ("archive", "start", "length"))):
                record = parse_record(zlib.decompress(reader.read(archive, start, length), 31))
                found.append(record if payloads else record | {"payload": None})
            yield pa.RecordBatch.from_pylist(found, schema=schema)
        reader.close()

    schema = pa.schema(
        [
            ("page_id", pa.int64()),
            ("url", pa.string()),
            ("record_type", pa.string()),
            ("refers_to", pa.int64()),
            ("payload", pa.binary()),
            ("payload_bytes", pa.int64()),
            ("payload_digest", pa.string()),
        ]
    )
    ranged = entries.withColumn("range", F.floor(F.col("start") / RANGE_BYTES))
    ranged = ranged.repartition("archive", "range").sortWithinPartitions("archive", "start")
    return ranged.select("archive", "start", "length").mapInArrow(run, _RECORD)


def archive_pages(pages: DataFrame, folder: str | None = None) -> tuple[DataFrame, list[Shard]]:
    """Archive (page_id, url, html); returns the stored index entries and the manifest."""
    folder = folder or scratch_path(pages.sparkSession, "warc")
    entries = write_archives(with_revisits(pages), f"{folder}/archives")
    return entries, write_index(entries, f"{folder}/index")


def read_back(urls: DataFrame, manifest: list[Shard], payloads: bool = True) -> DataFrame:
    """All captures of the URLs in column ``url``, through the index."""
    keys = urls.select(url_key(F.col("url")).alias("key")).distinct()
    return read_records(lookup(keys, manifest), payloads)
