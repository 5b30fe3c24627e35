"""Alignment of two tokenizers over the same bytes.

Side A is a byte-level BPE file, side B a sentencepiece model that puts a space before the text;
both read space + text. Two tokens are linked where their byte ranges overlap. In each batch,
keyed by document, ``merge_asof`` finds for every token start the token of the other side that
covers it; the union of both directions gives each overlap once, by the later of the two
starts. Ends that both sides share cut the tokens into groups.

Token ids and the order of links are written once, two bytes a token and one a link. The
documents that hold a pair of ids are counted from that table: distinct pairs per document,
summed within each task, then by a partially aggregated ``groupBy``. Documents then look their
links up in the sorted counts, which a worker holds while they are below ``RESIDENT_BYTES``
(their number is bounded by the product of both vocabularies only); beyond that, distinct pairs
per document are joined with the counts.

Defined results: texts that are null or empty, or that one side does not give back byte by byte,
have no tokens: zeros, and '' as groups. Each row counts as a document of its own. Rows are kept
as they are, repeated rows included; an empty table gives an empty result. Result columns
replace input columns of the same names. A text's length is bounded by memory only.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triplewright.llm.batches import Columns, add_columns, cut
from triplewright.llm.files import open_fs
from triplewright.operators.skew import skew_join
from triplewright.session import materialize, scratch_path

# Text that is aligned in one go, in characters, and links that are counted in one go.
BLOCK_CHARS = 1 << 18
BLOCK_LINKS = 1 << 18
# Rows that are read and passed on at once.
BLOCK_ROWS = 256
# Distinct pairs that a task keeps before it passes their counts on.
TASK_PAIRS = 1 << 22
# Stored counts that one worker may hold, at 16 bytes a pair.
RESIDENT_BYTES = 256 << 20

_STEP_A, _STEP_B = 1, 2


# Tokenizers


def byte_characters() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary: printable Latin-1 for
    itself, the other bytes from U+0100 on in their order."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(0x100 + i): b for i, b in enumerate(others)}


class Side:
    """Ids of texts, and the bytes of each id."""

    def __init__(self, encode: Callable[[list[str]], list[list[int]]], pieces: list[bytes]) -> None:
        self.encode, self.pieces = encode, pieces
        self.widths = np.array([len(piece) for piece in pieces], dtype=np.int64)

    def bytes_of(self, ids: list[int]) -> bytes:
        return b"".join(map(self.pieces.__getitem__, ids))


@lru_cache(maxsize=2)
def byte_level_side(path: str, pattern: str) -> Side:
    """A byte-level BPE file. Its vocabulary numbers tokens in the order of their merges, which is
    all that a rank-based encoder needs; that encoder gives the same ids several times faster."""
    import tiktoken

    with open(path, encoding="utf-8") as file:
        stored = json.load(file)
    special = {token["content"] for token in stored["added_tokens"] if token["special"]}
    byte_of = byte_characters()
    vocabulary = stored["model"]["vocab"]
    ranks = {bytes(byte_of[c] for c in token): i for token, i in vocabulary.items() if token not in special}
    pieces = [b""] * (max(vocabulary.values()) + 1)
    for piece, i in ranks.items():
        pieces[i] = piece
    encoder = tiktoken.Encoding("side", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return Side(lambda texts: [encoder.encode_ordinary(" " + text) for text in texts], pieces)


@lru_cache(maxsize=2)
def piece_side(path: str) -> Side:
    """A sentencepiece model with byte fallback."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [
        bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode()
        for i, piece in ((i, model.id_to_piece(i)) for i in range(model.get_piece_size()))
    ]
    return Side(lambda texts: model.encode(texts, num_threads=1), pieces)


# Alignment of a batch


def _starts(widths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    ends = np.cumsum(widths)
    return ends - widths, ends


def overlaps(a_start: np.ndarray, a_doc: np.ndarray, b_start: np.ndarray, b_doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the overlapping tokens of both sides, in the order of their bytes. Starts ascend."""
    a = pd.DataFrame({"start": a_start, "doc": a_doc, "a": np.arange(len(a_start)), "a_start": a_start})
    b = pd.DataFrame({"start": b_start, "doc": b_doc, "b": np.arange(len(b_start))})
    by_a = pd.merge_asof(a, b, on="start", by="doc")
    by_b = pd.merge_asof(b, a, on="start", by="doc")
    by_b = by_b[(by_b["start"] != by_b["a_start"]).to_numpy()]  # equal starts are in the other direction
    starts = np.concatenate([by_a["start"].to_numpy(), by_b["start"].to_numpy()])
    order = np.argsort(starts, kind="stable")
    found = (np.concatenate([by_a[side].to_numpy(), by_b[side].to_numpy()])[order] for side in ("a", "b"))
    return tuple(x.astype(np.int64) for x in found)


@lru_cache(maxsize=8)
def _written(n: int, mark: str) -> np.ndarray:
    """Each id in decimals with a mark behind it, padded with zero bytes."""
    return np.array([f"{i}{mark}".encode() for i in range(n)])


def _group_texts(a: np.ndarray, b: np.ndarray, a_last: np.ndarray, b_last: np.ndarray, sizes: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """All groups of a batch as bytes, and where each token of A and B, in their written order, ends in them.

    ``a_last`` and ``b_last`` mark the last tokens of groups; both have as many groups.
    """
    a_group, b_group = np.cumsum(a_last) - a_last, np.cumsum(b_last) - b_last
    # Before a token of A stand the tokens of B of earlier groups, before one of B also A's of its own.
    b_until = np.flatnonzero(b_last) + 1
    a_until = np.flatnonzero(a_last) + 1
    a_at = np.arange(len(a)) + np.concatenate([[0], b_until])[a_group]
    b_at = np.arange(len(b)) + a_until[b_group]
    width = max(len(str(size)) for size in sizes) + 1
    cells = np.empty(len(a) + len(b), dtype=f"S{width}")
    cells[a_at] = np.where(a_last, _written(sizes[0], "|")[a], _written(sizes[0], ",")[a])
    cells[b_at] = np.where(b_last, _written(sizes[1], ";")[b], _written(sizes[1], ",")[b])
    flat = cells.view(np.uint8).reshape(-1, width)
    used = flat != 0
    return flat[used], np.cumsum(used.sum(axis=1))


def _align_block(texts: list[str], side_a: Side, side_b: Side, kinds: tuple[str, str]) -> list[tuple]:
    """n_a, n_b, n_groups, n_links, groups digest, ids of A, ids of B, steps of each text; none is empty."""
    ids_a, ids_b = side_a.encode(texts), side_b.encode(texts)
    whole = [(" " + text).encode("utf-8", "surrogatepass") for text in texts]
    same = [side_a.bytes_of(a) == want and side_b.bytes_of(b) == want for a, b, want in zip(ids_a, ids_b, whole)]
    good = [i for i, ok in enumerate(same) if ok]
    rows: list[tuple] = [(0, 0, 0, 0, "", b"", b"", b"")] * len(texts)
    if not good:
        return rows
    counts = [np.array([len(ids[i]) for i in good]) for ids in (ids_a, ids_b)]
    a, b = (np.fromiter(chain.from_iterable(ids[i] for i in good), dtype=np.int64) for ids in (ids_a, ids_b))
    (a_start, a_end), (b_start, b_end) = _starts(side_a.widths[a]), _starts(side_b.widths[b])
    a_doc, b_doc = (np.repeat(np.arange(len(good)), n) for n in counts)
    a_of, b_of = overlaps(a_start, a_doc, b_start, b_doc)
    steps = np.empty(len(a_of), dtype=np.uint8)
    steps[:1] = _STEP_A | _STEP_B
    steps[1:] = _STEP_A * (np.diff(a_of) > 0) | _STEP_B * (np.diff(b_of) > 0)
    a_last, b_last = (np.isin(x, y, assume_unique=True) for x, y in ((a_end, b_end), (b_end, a_end)))
    written, token_ends = _group_texts(a, b, a_last, b_last, (len(side_a.pieces), len(side_b.pieces)))
    # Where each text's tokens, links and groups end.
    a_until, b_until = (np.cumsum(n) for n in counts)
    links_until = np.searchsorted(a_of, a_until)
    groups_until = np.cumsum(a_last)[a_until - 1]
    text_until = token_ends[a_until + b_until - 1]
    packed = [ids.astype(kind) for ids, kind in zip((a, b), kinds)]
    at = [0] * 5
    for i, *until in zip(good, *(x.tolist() for x in (a_until, b_until, groups_until, links_until, text_until))):
        own = [slice(x, y) for x, y in zip(at, until)]
        n_a, n_b, n_groups, n_links = (s.stop - s.start for s in own[:4])
        # The mark behind the last group is not part of its text.
        digest = hashlib.sha256(written[own[4]][:-1].tobytes()).hexdigest()
        rows[i] = (n_a, n_b, n_groups, n_links, digest, packed[0][own[0]].tobytes(), packed[1][own[1]].tobytes(), steps[own[3]].tobytes())
        at = until
    return rows


_ALIGNED = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
_STORED = "__a binary, __b binary, __steps binary"


def _align(path_a: str, pattern: str, path_b: str) -> Callable[[list[str | None]], Columns]:
    def run(texts: list[str | None]) -> Columns:
        side_a, side_b = byte_level_side(path_a, pattern), piece_side(path_b)
        kinds = tuple(_id_kind(len(side.pieces)) for side in (side_a, side_b))
        rows: list[tuple] = [(0, 0, 0, 0, "", b"", b"", b"")] * len(texts)
        block, size = [], 0
        for i in [i for i, text in enumerate(texts) if text] + [None]:
            if block and (i is None or size + len(texts[i]) > BLOCK_CHARS):
                for j, row in zip(block, _align_block([texts[j] for j in block], side_a, side_b, kinds)):
                    rows[j] = row
                block, size = [], 0
            if i is not None:
                block.append(i)
                size += len(texts[i])
        names = [field.split()[0] for field in f"{_ALIGNED}, {_STORED}".split(", ")]
        return dict(zip(names, map(list, zip(*rows))))

    return run


def _id_kind(n: int) -> str:
    return "<u2" if n <= 1 << 16 else "<u4"


# Pairs of ids


def _linked_pairs(a: list[bytes], b: list[bytes], steps: list[bytes], kinds: tuple[str, str], n_b: int) -> tuple[np.ndarray, np.ndarray]:
    """Pair number of each link, and the number of links of each text."""
    ids_a, ids_b = (np.frombuffer(b"".join(ids), kind) for ids, kind in zip((a, b), kinds))
    step = np.frombuffer(b"".join(steps), np.uint8)
    at_a, at_b = np.cumsum(step & _STEP_A) - 1, np.cumsum(step >> 1) - 1
    return ids_a[at_a].astype(np.int64) * n_b + ids_b[at_b], np.array([len(s) for s in steps], dtype=np.int64)


def _blocks(*columns: list[bytes]) -> Iterator[tuple[list[bytes], ...]]:
    """Runs of texts with a bounded number of links; the last column has the steps."""
    at, size = 0, 0
    for i, steps in enumerate(columns[-1]):
        if i > at and size + len(steps) > BLOCK_LINKS:
            yield tuple(column[at:i] for column in columns)
            at, size = i, 0
        size += len(steps)
    if at < len(columns[-1]):
        yield tuple(column[at:] for column in columns)


def _distinct(doc: np.ndarray, pair: np.ndarray, n_pairs: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (text, pair), and how often each occurs."""
    keys, times = np.unique(doc * n_pairs + pair, return_counts=True)
    return keys // n_pairs, keys % n_pairs, times


def _sum_by_pair(pairs: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(pairs, kind="stable")
    pairs = pairs[order]
    first = np.flatnonzero(np.diff(pairs, prepend=-1))
    return pairs[first], np.add.reduceat(counts[order], first) if len(first) else counts[:0]


def _count_pairs(kinds: tuple[str, str], n_a: int, n_b: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(pair, n) of each task: how many texts hold the pair."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0
        for batch in cut(batches, BLOCK_ROWS):
            for block in _blocks(*(column.to_pylist() for column in batch.columns)):
                pair, links = _linked_pairs(*block, kinds, n_b)
                _, own, _ = _distinct(np.repeat(np.arange(len(links)), links), pair, n_a * n_b)
                kept.append(np.unique(own, return_counts=True))
                size += len(kept[-1][0])
                if size > TASK_PAIRS:
                    kept = [_sum_by_pair(*map(np.concatenate, zip(*kept)))]
                    size = len(kept[0][0])
                    if size > TASK_PAIRS // 2:
                        yield pa.RecordBatch.from_arrays([pa.array(x) for x in kept[0]], names=["pair", "n"])
                        kept, size = [], 0
        if kept:
            arrays = _sum_by_pair(*map(np.concatenate, zip(*kept)))
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in arrays], names=["pair", "n"])

    return run


@lru_cache(maxsize=2)
def _resident(files: tuple[str, ...]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted pairs, their counts, and whether a count is the highest of its id of A."""
    pairs, counts, best = [], [], []
    for uri in files:
        system, path = open_fs(uri)
        table = pq.read_table(path, filesystem=system)
        for parts, name in ((pairs, "pair"), (counts, "n"), (best, "best")):
            parts.append(table[name].to_numpy())
    order = np.argsort(joined := np.concatenate(pairs))
    return joined[order], np.concatenate(counts)[order].astype(np.int32), np.concatenate(best)[order]


def _look_up(files: tuple[str, ...], kinds: tuple[str, str], n_b: int) -> Callable[..., Columns]:
    def run(a: list[bytes], b: list[bytes], steps: list[bytes]) -> Columns:
        best, sums = [], []
        for block in _blocks(a, b, steps):
            pair, links = _linked_pairs(*block, kinds, n_b)
            own, place = np.unique(pair, return_inverse=True)
            ends = np.concatenate([[0], np.cumsum(links)])
            for result, values in ((sums, 1), (best, 2)):
                if len(own):
                    pairs, *stored = _resident(files)
                    of_link = stored[values - 1][np.searchsorted(pairs, own)][place]
                else:
                    of_link = np.empty(0, dtype=np.int64)
                until = np.concatenate([[0], np.cumsum(of_link, dtype=np.int64)])[ends]
                result += np.diff(until).tolist()
        return {"n_best": best, "count_sum": sums}

    return run


def _join_counts(stored: DataFrame, counts: DataFrame, kinds: tuple[str, str], n_a: int, n_b: int) -> DataFrame:
    """The same for any number of pairs: distinct pairs of each text, joined with their counts."""

    def pairs_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in cut(batches, BLOCK_ROWS):
            rows, *columns = batch.columns
            at = 0
            for block in _blocks(*(column.to_pylist() for column in columns)):
                pair, links = _linked_pairs(*block, kinds, n_b)
                doc, own, times = _distinct(np.repeat(np.arange(len(links)), links), pair, n_a * n_b)
                row = rows.take(pa.array(doc + at))
                yield pa.RecordBatch.from_arrays([row, pa.array(own), pa.array(times)], names=["__row", "pair", "times"])
                at += len(links)

    held = stored.select("__row", "__a", "__b", "__steps").mapInArrow(pairs_of, "__row long, pair long, times long")
    sums = (
        skew_join(held, counts, "pair")
        .groupBy("__row")
        .agg(F.sum(F.col("times") * F.col("best").cast("long")).alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum"))
    )
    joined = stored.drop("__a", "__b", "__steps", "n_best", "count_sum").join(sums, "__row", "left")
    return joined.fillna(0, ["n_best", "count_sum"]).drop("__row")


def align(
    df: DataFrame, path_a: str, pattern: str, path_b: str, text: str = "text", resident_bytes: int = RESIDENT_BYTES
) -> DataFrame:
    """Replace ``text`` by its alignment: tokens of both sides, groups, links, and the counts of linked pairs.

    ``n_best`` counts the links whose pair is held by as many documents as any pair of its id of
    A; ``count_sum`` adds up over all links how many documents hold their pair.
    """
    n_a, n_b = len(byte_level_side(path_a, pattern).pieces), len(piece_side(path_b).pieces)
    kinds = _id_kind(n_a), _id_kind(n_b)
    spark, path = df.sparkSession, scratch_path(df.sparkSession, "aligned")
    aligned = add_columns(df, [text], f"{_ALIGNED}, {_STORED}", _align(path_a, pattern, path_b), True, BLOCK_ROWS)
    # Numbered as they are written, so that rows can be told apart from then on.
    aligned.withColumn("__row", F.monotonically_increasing_id()).write.option("compression", "zstd").parquet(path)
    stored = spark.read.parquet(path)
    # Ids of A have at most one row a pair, and pairs were summed in their tasks.
    per_task = stored.select("__a", "__b", "__steps").mapInArrow(_count_pairs(kinds, n_a, n_b), "pair long, n long")
    summed = materialize(per_task.groupBy("pair").agg(F.sum("n").alias("n")), "pairs")
    id_a = F.expr(f"pair div {n_b}")
    highest = summed.groupBy(id_a.alias("id_a")).agg(F.max("n").alias("highest"))
    counts = (
        summed.withColumn("id_a", id_a)
        .join(F.broadcast(highest), "id_a")  # at most one row for each id of the vocabulary of A
        .select("pair", "n", (F.col("n") == F.col("highest")).alias("best"))
    )
    counts = materialize(counts, "pair_counts")
    if counts.count() * 16 > resident_bytes:
        return _join_counts(stored, counts, kinds, n_a, n_b)
    files = tuple(sorted(row[0] for row in counts.select(F.input_file_name()).distinct().collect()))
    look_up = _look_up(files, kinds, n_b)
    return add_columns(stored.drop("__row"), ["__a", "__b", "__steps"], "n_best long, count_sum long", look_up, True, BLOCK_ROWS)
