"""Removal of lines that repeat across documents.

A line's key is the line without white space at both ends and with A-Z lower-cased. Keys that
are long enough and occur in enough documents stay only in the document of the largest id
that holds them; there, all lines of the key stay.

Keys are 128-bit digests. Spark counts the documents of each digest with partial aggregation.
The repeated digests are dealt to shards, and each shard becomes a minimal perfect hash with
arrays of fingerprints, counts and largest ids, 20 bytes and about 4 bits a key. Documents
probe these arrays, so no line is shuffled or joined: a worker holds all shards while they are
below ``RESIDENT_BYTES``. Beyond that, blocks of documents send their distinct digests to the
shards and get the repeated ones back, so a line in a third of all documents costs a shard one
row a block.

Defined results: a null or empty text is one empty line. Each row counts as a document of its
own, whatever its id; a null id is smaller than all others. Rows are kept as they are, repeated
rows included, and an empty table gives an empty result. ``\\n`` splits lines; a text's length
is bounded by memory only. Result columns replace input columns of the same names.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triplewright.llm.batches import Columns, add_columns
from triplewright.llm.files import open_fs
from triplewright.llm.words import mix, utf8
from triplewright.session import materialize

MIN_CODE_POINTS = 20
MIN_DOCUMENTS = 3
# Keys of a shard, on average.
SHARD_KEYS = 1 << 18
# Arrays that one worker may hold; larger indexes are probed shard by shard.
RESIDENT_BYTES = 256 << 20
# Text of a block of documents that probes together, on average.
BLOCK_BYTES = 32 << 20
# Bits a key on each level of the perfect hash.
GAMMA = 2

STRIPPED = b" \t\n\x0b\x0c\r"
_U = np.uint64
_LEVEL = 0x9E3779B97F4A7C15
_INDEX_SCHEMA = "shard int, sizes binary, bits binary, prints binary, counts binary, holders binary"


# Keys


def _long_enough(key: bytes, least: int) -> bool:
    return len(key) >= least and (key.isascii() or len(key.decode("utf-8", "surrogatepass")) >= least)


def line_digests(lines: list[bytes], least: int) -> tuple[list[int], list[bytes]]:
    """Numbers and digests of the lines whose keys are long enough."""
    numbers, digests = [], []
    for number, line in enumerate(lines):
        key = line.strip(STRIPPED).lower()
        if _long_enough(key, least):
            numbers.append(number)
            digests.append(hashlib.blake2b(key, digest_size=16).digest())
    return numbers, digests


def _halves(digests: bytes) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(digests, dtype="<u8").reshape(-1, 2)
    return both[:, 0], both[:, 1]


# Minimal perfect hash


def _places(high: np.ndarray, low: np.ndarray, level: int, size: int) -> np.ndarray:
    salt = _U(_LEVEL * (level + 1) % (1 << 64))
    return (mix(low ^ mix(high + salt)) % _U(size)).astype(np.int64)


class PerfectHash:
    """Numbers distinct 128-bit keys from 0 without gaps.

    On each level every key takes a place; keys alone at their place get its bit, the others go
    to the next level. A key's number is the count of bits before its own. Other keys get some
    number or -1, which fingerprints tell apart.
    """

    def __init__(self, sizes: np.ndarray, words: np.ndarray) -> None:
        self.sizes, self.words = sizes, words
        self._before = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)])

    @classmethod
    def of(cls, high: np.ndarray, low: np.ndarray) -> PerfectHash:
        sizes, levels = [], []
        while len(high):
            size = math.ceil(GAMMA * len(high) / 64) * 64
            at = _places(high, low, len(sizes), size)
            alone = np.bincount(at, minlength=size) == 1
            sizes.append(size)
            levels.append(np.packbits(alone, bitorder="little").view("<u8"))
            rest = ~alone[at]
            high, low = high[rest], low[rest]
        return cls(np.array(sizes, dtype=np.int64), np.concatenate(levels) if levels else np.empty(0, dtype="<u8"))

    def numbers(self, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        found, open_, first = np.full(len(high), -1, dtype=np.int64), np.arange(len(high)), 0
        for level, size in enumerate(self.sizes):
            at = first + _places(high[open_], low[open_], level, int(size))
            word, bit = self.words[at >> 6], (at & 63).astype(_U)
            hit = (word >> bit) & _U(1) == 1
            below = np.bitwise_count(word[hit] & ((_U(1) << bit[hit]) - _U(1)))
            found[open_[hit]] = self._before[at[hit] >> 6] + below
            open_, first = open_[~hit], first + int(size)
        return found


class Shard:
    """Fingerprint, count of documents and largest id of each key of a shard."""

    def __init__(self, row: dict) -> None:
        self.hash = PerfectHash(np.frombuffer(row["sizes"], "<i8"), np.frombuffer(row["bits"], "<u8"))
        self.prints, self.counts, self.holders = (
            np.frombuffer(row[name], kind) for name, kind in (("prints", "<u8"), ("counts", "<u4"), ("holders", "<i8"))
        )

    def probe(self, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        """Number of each key in the arrays, or -1."""
        at = self.hash.numbers(high, low)
        if len(self.prints):
            at[self.prints[at] != high] = -1
        return at


#: Stands for the largest id of a key that only rows without an id hold.
NO_ID = np.iinfo(np.int64).min


def _pack(shard: int, high: np.ndarray, low: np.ndarray, counts: np.ndarray, holders: np.ndarray) -> dict:
    order = PerfectHash.of(high, low)
    at = order.numbers(high, low)
    placed = {"prints": (high, "<u8"), "counts": (np.minimum(counts, 0xFFFFFFFF), "<u4"), "holders": (holders, "<i8")}
    row = {"shard": shard, "sizes": order.sizes.astype("<i8").tobytes(), "bits": order.words.tobytes()}
    for name, (values, kind) in placed.items():
        array = np.empty(len(high), dtype=kind)
        array[at] = values
        row[name] = array.tobytes()
    return row


_ARROW_INDEX = pa.schema([("shard", pa.int32()), *((n, pa.binary()) for n in ("sizes", "bits", "prints", "counts", "holders"))])


def _build(table: pa.Table) -> pa.Table:
    high, low = (table[name].to_numpy().view(_U) for name in ("high", "low"))
    counts, holders = table["n"].to_numpy(), table["holder"].to_numpy()
    return pa.Table.from_pylist([_pack(table["shard"][0].as_py(), high, low, counts, holders)], schema=_ARROW_INDEX)


# Counting and indexing


def _digest_rows(least: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tags, texts = batch.column(0), batch.column(1).cast(pa.binary()).to_pylist()
            own = [set(line_digests((text or b"").split(b"\n"), least)[1]) for text in texts]
            high, low = _halves(b"".join(b"".join(digests) for digests in own))
            tag = tags.take(pa.array(np.repeat(np.arange(len(own)), [len(digests) for digests in own])))
            arrays = [pa.array(high.view(np.int64)), pa.array(low.view(np.int64)), tag]
            yield pa.RecordBatch.from_arrays(arrays, names=["high", "low", "tag"])

    return run


def _digests(df: DataFrame, tag: str, text: str, least: int) -> DataFrame:
    """(high, low, tag): the distinct digests of each row."""
    rows = df.select(F.col(tag).cast("long").alias("tag"), text)
    return rows.mapInArrow(_digest_rows(least), "high long, low long, tag long")


class LineIndex:
    """Shards of repeated lines in the shared folder."""

    def __init__(self, rows: DataFrame, n_shards: int) -> None:
        self.rows, self.n_shards = rows, n_shards
        widths = sum((F.octet_length(name) for name in ("bits", "prints", "counts", "holders")), F.lit(0))
        self.bytes = rows.agg(F.sum(widths.cast("long"))).first()[0] or 0
        self.files = [row[0] for row in rows.select(F.input_file_name()).distinct().collect()]


def index_lines(
    df: DataFrame, key: str = "doc_id", text: str = "text", least: int = MIN_CODE_POINTS, documents: int = MIN_DOCUMENTS
) -> LineIndex:
    """Index of the line keys of at least ``least`` code points that at least ``documents`` rows hold."""
    counted = _digests(df, key, text, least).groupBy("high", "low").agg(F.count("*").alias("n"), F.max("tag").alias("holder"))
    repeated = materialize(
        counted.filter(F.col("n") >= documents).withColumn("holder", F.coalesce("holder", F.lit(int(NO_ID)))), "repeated_lines"
    )
    n_shards = max(1, math.ceil(repeated.count() / SHARD_KEYS))
    sharded = repeated.withColumn("shard", F.pmod("high", F.lit(n_shards)).cast("int"))
    return LineIndex(materialize(sharded.groupBy("shard").applyInArrow(_build, _INDEX_SCHEMA), "line_index"), n_shards)


# Probing


@lru_cache(maxsize=2)
def _resident(files: tuple[str, ...]) -> dict[int, Shard]:
    shards = {}
    for uri in files:
        system, path = open_fs(uri)
        for row in pq.read_table(path, filesystem=system).to_pylist():
            shards[row["shard"]] = Shard(row)
    return shards


def _by_shard(high: np.ndarray, n_shards: int) -> Iterator[tuple[int, np.ndarray]]:
    """Each shard, and which digests it would hold."""
    shard = high.view(np.int64) % n_shards
    order = np.argsort(shard, kind="stable")
    numbers, starts = np.unique(shard[order], return_index=True)
    yield from zip(numbers.tolist(), np.split(order, starts[1:]))


def _drop_lines(
    ids: list[int | None], texts: list[bytes | None], least: int, holders_of: Callable[[np.ndarray, np.ndarray], tuple]
) -> Columns:
    """``holders_of`` tells which digests are repeated, and the largest id of each."""
    lines = [(text or b"").split(b"\n") for text in texts]
    keyed = [line_digests(own, least) for own in lines]
    high, low = _halves(b"".join(b"".join(digests) for _, digests in keyed))
    repeated, holders = holders_of(high, low)
    own_ids = np.array([NO_ID if i is None else i for i in ids], dtype=np.int64)
    lost = repeated & (holders != np.repeat(own_ids, [len(numbers) for numbers, _ in keyed]))
    kept, dropped, at = [], [], 0
    for own, (numbers, _) in zip(lines, keyed):
        gone = {number for number, out in zip(numbers, lost[at : at + len(numbers)].tolist()) if out}
        at += len(numbers)
        kept.append(b"\n".join([line for i, line in enumerate(own) if i not in gone] if gone else own))
        dropped.append(len(gone))
    return {
        "n_lines": [len(own) for own in lines],
        "n_dropped": dropped,
        "kept_text": pa.array(kept, pa.binary()).cast(pa.string()),
    }


_FIELDS = "n_lines long, n_dropped long, kept_text string"


def _probe_resident(df: DataFrame, index: LineIndex, key: str, text: str, least: int) -> DataFrame:
    files, n_shards = tuple(sorted(index.files)), index.n_shards

    def holders_of(high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        repeated, holders = np.zeros(len(high), dtype=bool), np.zeros(len(high), dtype=np.int64)
        for number, own in _by_shard(high, n_shards):
            if shard := _resident(files).get(number):
                at = shard.probe(high[own], low[own])
                repeated[own] = at >= 0
                holders[own[at >= 0]] = shard.holders[at[at >= 0]]
        return repeated, holders

    def run(ids: list, texts: list) -> Columns:
        return _drop_lines(ids, [None if t is None else utf8(t) for t in texts], least, holders_of)

    return add_columns(df, [key, text], _FIELDS, run)


def _probe_by_shard(df: DataFrame, index: LineIndex, key: str, text: str, least: int) -> DataFrame:
    """The same for any size of the index: blocks ask the shards for their distinct digests."""
    size = df.agg(F.sum(F.octet_length(text).cast("long"))).first()[0] or 0
    n_blocks, n_shards = max(1, math.ceil(size / BLOCK_BYTES)), index.n_shards
    replaced = ("n_lines", "n_dropped", "kept_text")
    blocks = df.drop(*replaced).withColumn("__block", F.pmod(F.xxhash64(key, text), F.lit(n_blocks)))
    asked = _digests(blocks, "__block", text, least).dropDuplicates().withColumn("shard", F.pmod("high", F.lit(n_shards)).cast("int"))

    def probe(questions: pa.Table, stored: pa.Table) -> pa.Table:
        found = questions.schema.remove(questions.schema.get_field_index("shard")).append(pa.field("holder", pa.int64()))
        if not questions.num_rows or not stored.num_rows:
            return found.empty_table()
        shard = Shard(stored.to_pylist()[0])
        at = shard.probe(*(questions[name].to_numpy().view(_U) for name in ("high", "low")))
        hits = questions.drop_columns(["shard"]).filter(pa.array(at >= 0))
        return hits.append_column("holder", pa.array(shard.holders[at[at >= 0]]))

    hits = asked.groupBy("shard").cogroup(index.rows.groupBy("shard")).applyInArrow(probe, "high long, low long, tag long, holder long")
    names = [f.name for f in blocks.schema if f.name != "__block"]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in blocks.schema if f.name != "__block"), _FIELDS])

    def decide(documents: pa.Table, repeated: pa.Table) -> pa.Table:
        known = dict(zip(zip(repeated["high"].to_pylist(), repeated["low"].to_pylist()), repeated["holder"].to_pylist()))

        def holders_of(high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            own = [known.get(pair) for pair in zip(high.view(np.int64).tolist(), low.view(np.int64).tolist())]
            holders = np.array([0 if holder is None else holder for holder in own], dtype=np.int64)
            return np.array([holder is not None for holder in own], dtype=bool), holders

        texts = documents[text].cast(pa.binary()).to_pylist()
        added = _drop_lines(documents[key].to_pylist(), texts, least, holders_of)
        result = documents.select(names)
        for name in replaced:
            values = added[name]
            result = result.append_column(name, values if isinstance(values, pa.Array) else pa.array(values, pa.int64()))
        return result

    return blocks.groupBy("__block").cogroup(hits.withColumnRenamed("tag", "__block").groupBy("__block")).applyInArrow(decide, schema)


def drop_repeated_lines(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    least: int = MIN_CODE_POINTS,
    documents: int = MIN_DOCUMENTS,
    resident_bytes: int = RESIDENT_BYTES,
) -> DataFrame:
    """Add ``n_lines``, ``n_dropped`` and ``kept_text`` to each row; ``key`` is an integer column."""
    index = index_lines(df, key, text, least, documents)
    probe = _probe_resident if index.bytes <= resident_bytes else _probe_by_shard
    return probe(df, index, key, text, least)
