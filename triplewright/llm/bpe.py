"""Byte-level BPE on padded numpy matrices.

Texts are split by the tokenizer's pattern; distinct matches of a batch are encoded once.
Matches of about the same length form a matrix with one row per match and one column per
token, at first one per byte. Each round, every row merges its leftmost pair of minimum
rank, looked up in an open-addressing hash table of token pairs; finished rows leave the
matrix and the rest is compacted. Matches longer than ``LONGEST_ROW`` bytes, for which a
round per merge would cost the square of their length, go through a heap of the same pairs
in the same order.

Decoding gathers token bytes from one array. Defined results: a null text encodes as an
empty one (no tokens, the digest of no bytes). Rows are encoded one by one, so repeated
rows, null ids and empty tables need no special case. Result columns replace input columns
of the same names.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import regex
from pyspark.sql import DataFrame

from triplewright.llm.batches import Columns, add_columns
from triplewright.llm.words import utf8

# Pairs whose rank is not in the table.
NO_RANK = np.int64(1 << 40)
LONGEST_ROW = 256
# Cells of one matrix.
MATRIX_CELLS = 1 << 20
# Matches whose tokens a worker remembers before it starts anew.
REMEMBERED = 200_000
# Characters tokenized in one go.
PIECE_CHARS = 1 << 20
_MIX = np.uint64(0x9E3779B97F4A7C15)


class PairTable:
    """(left token, right token) -> rank of the merged token, by open addressing."""

    def __init__(self, ranks: dict[bytes, int]):
        pairs = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = rank
        bits = max(4, (4 * len(pairs)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, -1, dtype=np.int64)
        self.ranks = np.full(1 << bits, NO_RANK, dtype=np.int64)
        keys = np.fromiter(pairs, dtype=np.int64, count=len(pairs))
        values = np.fromiter(pairs.values(), dtype=np.int64, count=len(pairs))
        place = self._home(keys)
        while len(keys):
            free = self.keys[place] == -1
            self.keys[place[free]] = keys[free]
            settled = self.keys[place] == keys
            self.ranks[place[settled]] = values[settled]
            keys, values, place = keys[~settled], values[~settled], (place[~settled] + 1) & self.mask
        self.pairs = pairs

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * _MIX) >> self.shift).astype(np.int64)

    def lookup(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair; NO_RANK where the pair doesn't merge."""
        keys = left << 32 | right
        place = self._home(keys)
        found = self.keys[place]
        result = np.where(found == keys, self.ranks[place], NO_RANK)
        open_ = np.flatnonzero((found != keys) & (found != -1))
        while len(open_):
            place[open_] = (place[open_] + 1) & self.mask
            found = self.keys[place[open_]]
            hit = found == keys[open_]
            result[open_[hit]] = self.ranks[place[open_[hit]]]
            open_ = open_[~hit & (found != -1)]
        return result


class Vocabulary:
    """Ranks of a rank file, ready to encode and decode."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.split = regex.compile(pattern)
        self.pairs = PairTable(self.ranks)
        self.byte_ids = np.array([self.ranks[bytes([b])] for b in range(256)], dtype=np.int64)
        size = max(self.ranks.values()) + 1
        tokens = [b""] * size
        for token, rank in self.ranks.items():
            tokens[rank] = token
        self.token_bytes = tokens
        self.remembered: dict[str, np.ndarray] = {}

    def encode(self, text: str) -> np.ndarray:
        """Token ids of a whole text, without special tokens."""
        matches = self.split.findall(text)
        self._learn(matches)
        if not matches:
            return np.empty(0, dtype="<u4")
        known = self.remembered
        return np.frombuffer(b"".join([known[match] for match in matches]), dtype="<u4")

    def encode_batch(self, texts: list[str]) -> Iterator[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers.

        Texts are taken in groups of bounded size, so that the matrices are well filled.
        """
        at = 0
        while at < len(texts):
            end, size = at, 0
            while end < len(texts) and (end == at or size + len(texts[end]) <= PIECE_CHARS):
                size += len(texts[end])
                end += 1
            split = [self.split.findall(text) for text in texts[at:end]]
            self._learn({match for matches in split for match in matches})
            known = self.remembered
            for matches in split:
                yield b"".join([known[match] for match in matches])
            at = end

    def decode(self, ids: bytes) -> bytes:
        """The bytes that packed token ids stand for."""
        tokens = self.token_bytes
        return b"".join([tokens[i] for i in np.frombuffer(ids, dtype="<u4").tolist()])

    def _learn(self, matches) -> None:
        """Encode the matches that aren't remembered yet."""
        new = [match for match in set(matches) if match not in self.remembered]
        if len(self.remembered) + len(new) > REMEMBERED:
            self.remembered.clear()
            new = list(set(matches))
        self.remembered.update(zip(new, self.encode_matches([utf8(match) for match in new])))

    def encode_matches(self, words: list[bytes]) -> list[bytes]:
        """Packed ids of each match."""
        result = [b""] * len(words)
        by_width: dict[int, list[int]] = {}
        for i, word in enumerate(words):
            whole = self.ranks.get(word)
            if whole is not None:
                result[i] = whole.to_bytes(4, "little")
            elif len(word) > LONGEST_ROW:
                result[i] = self._merge_long(word)
            else:
                width = len(word) if len(word) <= 16 else -(-len(word) // 16) * 16
                by_width.setdefault(width, []).append(i)
        for width, members in by_width.items():
            height = max(1, MATRIX_CELLS // width)
            for at in range(0, len(members), height):
                self._merge_rows([words[i] for i in members[at : at + height]], members[at : at + height], width, result)
        return result

    def _merge_rows(self, words: list[bytes], targets: list[int], width: int, result: list[bytes]) -> None:
        """Merge all rows of one matrix, writing packed ids to ``result[target]``."""
        lengths = np.array([len(word) for word in words])
        codes = np.frombuffer(b"".join(word.ljust(width, b"\0") for word in words), dtype=np.uint8)
        ids = self.byte_ids[codes].reshape(-1, width)
        column = np.arange(width)
        ranks = np.full((len(words), width), NO_RANK, dtype=np.int64)
        inside = column[:-1] + 1 < lengths[:, None]
        ranks[:, :-1][inside] = self.pairs.lookup(ids[:, :-1][inside], ids[:, 1:][inside])
        target = np.array(targets)
        while len(ids):
            place = ranks.argmin(axis=1)
            row = np.arange(len(ids))
            rank = ranks[row, place]
            done = rank == NO_RANK
            if done.any():
                packed = ids[done].astype("<u4")
                for i, own, n in zip(target[done].tolist(), packed, lengths[done].tolist()):
                    result[i] = own[:n].tobytes()
                going = ~done
                ids, ranks, lengths, target = ids[going], ranks[going], lengths[going], target[going]
                if not len(ids):
                    return
                place, rank, row = place[going], rank[going], np.arange(len(ids))
            # The merged token takes the left place; what stands right of it moves one to the left.
            after = column[:-1] > place[:, None]
            ids[:, :-1] = np.where(after, ids[:, 1:], ids[:, :-1])
            ranks[:, :-1] = np.where(after, ranks[:, 1:], ranks[:, :-1])
            ids[row, place] = rank
            lengths -= 1
            ranks[row, lengths - 1] = NO_RANK
            ranks[row, np.minimum(lengths, width - 1)] = NO_RANK
            right = np.flatnonzero(place + 1 < lengths)
            ranks[row[right], place[right]] = self.pairs.lookup(ids[right, place[right]], ids[right, place[right] + 1])
            left = np.flatnonzero(place > 0)
            ranks[row[left], place[left] - 1] = self.pairs.lookup(ids[left, place[left] - 1], ids[left, place[left]])
            if width > 8 and lengths.max() <= width * 3 // 4:
                width = int(lengths.max())
                ids, ranks, column = ids[:, :width].copy(), ranks[:, :width].copy(), column[:width]

    def _merge_long(self, word: bytes) -> bytes:
        """The same merges in the same order for one long match, by a heap of (rank, place)."""
        pairs, n = self.pairs.pairs, len(word)
        ids = self.byte_ids[np.frombuffer(word, dtype=np.uint8)].tolist()
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [(rank, i) for i in range(n - 1) if (rank := pairs.get(ids[i] << 32 | ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            j = after[i]
            if ids[i] < 0 or j >= n or pairs.get(ids[i] << 32 | ids[j]) != rank:
                continue
            ids[i], ids[j] = rank, -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
                if (new := pairs.get(rank << 32 | ids[after[i]])) is not None:
                    heapq.heappush(heap, (new, i))
            if before[i] >= 0 and (new := pairs.get(ids[before[i]] << 32 | rank)) is not None:
                heapq.heappush(heap, (new, before[i]))
        return np.array([i for i in ids if i >= 0], dtype="<u4").tobytes()


@lru_cache(maxsize=2)
def vocabulary(path: str, pattern: str) -> Vocabulary:
    """One per Python worker and file."""
    return Vocabulary(path, pattern)


def encode(df: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """Add ``ids``: the token ids of ``text`` as packed little-endian unsigned 32-bit integers."""

    def run(texts: list[str | None]) -> Columns:
        return {"ids": list(vocabulary(path, pattern).encode_batch(["" if t is None else t for t in texts]))}

    return add_columns(df, [text], "ids binary", run)


def decode(df: DataFrame, path: str, pattern: str) -> DataFrame:
    """Add ``decoded``: the bytes that ``ids`` stand for; null ids stand for none."""

    def run(packed: list[bytes | None]) -> Columns:
        return {"decoded": [vocabulary(path, pattern).decode(ids or b"") for ids in packed]}

    return add_columns(df, ["ids"], "decoded binary", run)


def round_trip(df: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """Encode, decode and digest in one pass: n_tokens, ids_sha256, decoded_sha256 instead of ``text``."""

    def run(texts: list[str | None]) -> Columns:
        words = vocabulary(path, pattern)
        counts, ids_digests, decoded_digests = [], [], []
        for ids in words.encode_batch(["" if t is None else t for t in texts]):
            counts.append(len(ids) // 4)
            ids_digests.append(hashlib.sha256(ids).hexdigest())
            decoded_digests.append(hashlib.sha256(words.decode(ids)).hexdigest())
        return {"n_tokens": counts, "ids_sha256": ids_digests, "decoded_sha256": decoded_digests}

    return add_columns(df, [text], "n_tokens long, ids_sha256 string, decoded_sha256 string", run, drop=True)
