"""Log-likelihood of whole texts by a gated recurrent model trained on the corpus.

1. Counts of all words of all training texts, keyed by 64-bit word hashes (two of n words
   share a hash with probability n*n / 2**65).
2. The model's vocabulary are the most frequent words. Gradient steps use every segment of
   ``SEGMENT`` words of all training texts once, dealt by hash over ``ROUNDS`` rounds. Each task
   trains on its texts; the weights of all tasks are averaged, by the words they saw, and the
   next round starts from the average. Weights are added up in a tree of tasks.
3. Scoring reads every text whole, the state carried across windows. A word outside the
   vocabulary has the model's probability of such a word times its share among all of
   them, smoothed as in the base score, with a place for words never seen.

Counts of the ``HEAD_WORDS`` most frequent words go along with the scoring tasks; those of
all others are joined. Such words are rare, so no key of this join is hot.

Defined results: a null text is an empty one and consists of its end only. A null id counts
as the empty string when the held-out part is chosen. Repeated rows are counted and scored one
by one. Without training texts all counts are 0. Only the id and text columns are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from triplewright.llm import gru
from triplewright.llm.batches import Columns, add_columns
from triplewright.llm.words import mix, utf8, word_hashes
from triplewright.session import materialize

# Bound of the word counts that every scoring task gets.
HEAD_WORDS = 1 << 18
ROUNDS = 2
SEGMENT = 4 * gru.WINDOW
# Weights that one task adds up, in a tree.
FAN_IN = 16
# Steps per doubling of the count histogram.
BINS = 16
_END_KEY = -1


def held_out(key: str) -> Column:
    """Whether a row is left out of training."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit(""))) % 5 == 1


def _count_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [utf8(text) for text in batch.column("text").to_pylist()]
        found = [hashes for _, hashes, _ in word_hashes(texts, lower=True)]
        keys, counts = np.unique(np.concatenate(found), return_counts=True) if found else (np.empty(0, np.uint64),) * 2
        keys = np.append(keys.view(np.int64), _END_KEY)
        counts = np.append(counts, len(texts)).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(counts)], names=["word", "n"])


def count_words(training: DataFrame) -> DataFrame:
    """(word, n) over all texts; the end of a text is a word, too."""
    counted = training.select("text").mapInArrow(_count_batch, "word long, n long")
    return materialize(counted.groupBy("word").agg(F.sum("n").alias("n")), "word_counts")


@dataclass(frozen=True)
class Counts:
    """What scoring tasks know of the counts: sums over all words, and the head, sorted by hash."""

    n_tokens: int
    n_distinct: int
    words: np.ndarray
    counts: np.ndarray
    # The head's places in the model's vocabulary; OTHER outside it.
    places: np.ndarray
    n_other: int
    distinct_other: int
    vocabulary_counts: np.ndarray

    def base(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + 0.5) / (self.n_tokens + 0.5 * (self.n_distinct + 1)))

    def share(self, counts: np.ndarray) -> np.ndarray:
        """Log probability among words outside the vocabulary."""
        return np.log10((counts + 0.5) / (self.n_other + 0.5 * (self.distinct_other + 1)))


def head_counts(counts: DataFrame) -> Counts:
    """The most frequent words, as many as fit: a histogram of counts gives the smallest count."""
    step = F.floor(F.log2("n") * BINS).cast("int")
    bins = counts.groupBy(step.alias("bin")).agg(F.count("*").alias("words"), F.sum("n").alias("tokens")).collect()
    total, lowest = 0, math.inf
    for row in sorted(bins, key=lambda row: -row["bin"]):
        if total + row["words"] > HEAD_WORDS:
            break
        total, lowest = total + row["words"], row["bin"]
    head = counts.filter(step >= lowest).collect() if total else []
    head = sorted(((row["word"], row["n"]) for row in head), key=lambda row: (-row[1], row[0]))
    n_end = next((n for word, n in head if word == _END_KEY), 0)
    ranked = [(word, n) for word, n in head if word != _END_KEY][: gru.N_WORDS - 2]
    place = {word: i + 2 for i, (word, _) in enumerate(ranked)} | {_END_KEY: gru.END}
    words = np.array([word for word, _ in head], dtype=np.int64).view(np.uint64)
    order = np.argsort(words)
    n_tokens, n_distinct = sum(row["tokens"] for row in bins), sum(row["words"] for row in bins)
    n_other = n_tokens - n_end - sum(n for _, n in ranked)
    vocabulary_counts = np.zeros(gru.N_WORDS)
    vocabulary_counts[gru.END], vocabulary_counts[gru.OTHER] = n_end, n_other
    vocabulary_counts[2 : 2 + len(ranked)] = [n for _, n in ranked]
    return Counts(
        n_tokens=n_tokens,
        n_distinct=n_distinct,
        words=words[order],
        counts=np.array([n for _, n in head], dtype=np.int64)[order],
        places=np.array([place.get(word, gru.OTHER) for word, _ in head], dtype=np.int64)[order],
        n_other=n_other,
        distinct_other=n_distinct - len(ranked) - (n_end > 0),
        vocabulary_counts=vocabulary_counts,
    )


def _find(known: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each hash among sorted known ones, and whether it is there."""
    if not len(known):
        return np.zeros(len(hashes), dtype=np.int64), np.zeros(len(hashes), dtype=bool)
    at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
    return at, known[at] == hashes


def _segments(words: np.ndarray, hashes: np.ndarray, turn: int) -> Iterator[tuple[int, np.ndarray]]:
    """The segments of one text that a round trains on, each in one round: the word before, and the words."""
    own = np.uint64(hashes[:8].sum(dtype=np.uint64)) + np.uint64(len(hashes))
    n = -(-len(words) // SEGMENT)
    drawn = mix(np.arange(n, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + own)
    for i in np.flatnonzero(drawn % np.uint64(ROUNDS) == np.uint64(turn)):
        at = int(i) * SEGMENT
        yield int(words[at - 1]) if at else gru.END, words[at : at + SEGMENT]


def train_round(training: DataFrame, counts: Counts, weights: gru.Parameters, turn: int) -> gru.Parameters:
    """Average of the weights that all tasks reach, each on its own texts, from the same start."""
    in_model = counts.places != gru.OTHER
    known, places = counts.words[in_model], counts.places[in_model]

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trainer = gru.Trainer(weights)
        for batch in batches:
            texts = [utf8(text) for text in batch.column("text").to_pylist()]
            for _, hashes, bounds in word_hashes(texts, lower=True):
                at, found = _find(known, hashes)
                words = np.where(found, places[at] if len(places) else 0, gru.OTHER)
                segments = []
                for begin, end in zip(bounds[:-1], bounds[1:]):
                    segments += _segments(np.append(words[begin:end], gru.END), hashes[begin:end], turn)
                if segments:
                    trainer.train(segments)
        if trainer.n_targets:
            flat = gru.pack(trainer.w).astype(np.float64) * trainer.n_targets
            yield _weights_row(TaskContext.get().partitionId(), trainer.n_targets, flat)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, None
        for batch in batches:
            for seen, flat in zip(batch.column("n").to_pylist(), batch.column("weights").to_pylist()):
                n, own = n + seen, np.frombuffer(flat, dtype=np.float64)
                total = own.copy() if total is None else total + own
        if n:
            yield _weights_row(TaskContext.get().partitionId(), n, total)

    schema = "merger int, n long, weights binary"
    trained = materialize(training.select("text").mapInArrow(train, schema), "weights")
    n_rows = trained.count()
    while n_rows > FAN_IN:
        n_rows = -(-n_rows // FAN_IN)
        dealt = trained.withColumn("merger", F.pmod("merger", F.lit(n_rows)).cast("int")).repartitionByRange(n_rows, "merger")
        trained = materialize(dealt.mapInArrow(merge, schema), "weights")
    merged = trained.collect()  # FAN_IN rows at most
    if not merged:
        return weights
    total = sum(np.frombuffer(row["weights"], dtype=np.float64) for row in merged)
    return gru.unpack(total / sum(row["n"] for row in merged))


def _weights_row(merger: int, n: int, flat: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([merger], pa.int32()), pa.array([n], pa.int64()), pa.array([flat.tobytes()], pa.binary())],
        names=["merger", "n", "weights"],
    )


_SCORES = "n_tokens long, head_known long, head_base double, head_score double, tail array<struct<word:long,times:int>>"


def _score_batch(counts: Counts, weights: gru.Parameters):
    def run(texts: list[str | None]) -> Columns:
        n = len(texts)
        n_tokens, known = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
        base, scores = np.zeros(n), np.zeros(n)
        words: list[np.ndarray] = []
        tail_words, tail_times, tail_sizes = [], [], np.zeros(n, dtype=np.int64)
        end_at, end_known = _find(counts.words, np.array([_END_KEY], dtype=np.int64).view(np.uint64))
        end_count = counts.counts[end_at[0]] if end_known[0] else 0
        for rows, hashes, bounds in word_hashes([utf8(text) for text in texts], lower=True):
            at, in_head = _find(counts.words, hashes)
            count = np.where(in_head, counts.counts[at] if len(counts.counts) else 0, 0)
            place = np.where(in_head, counts.places[at] if len(counts.places) else 0, gru.OTHER)
            text_of = np.repeat(np.arange(len(rows)), np.diff(bounds))
            sums = lambda values: np.bincount(text_of[in_head], weights=values, minlength=len(rows))
            where = slice(rows.start, rows.stop)
            n_tokens[where] = np.diff(bounds) + 1
            known[where] = sums(None) + (end_count > 0)
            base[where] = sums(counts.base(count[in_head])) + counts.base(np.array(end_count))
            other = np.where(place[in_head] == gru.OTHER, counts.share(count[in_head]), 0.0)
            words += [np.append(place[b:e], gru.END).astype(np.int16) for b, e in zip(bounds[:-1], bounds[1:])]
            scores[where] = sums(other)
            word, text = hashes[~in_head], text_of[~in_head]
            order = np.lexsort((word, text))
            word, text = word[order], text[order]
            first = np.ones(len(word), dtype=bool)
            first[1:] = (word[1:] != word[:-1]) | (text[1:] != text[:-1])
            starts = np.flatnonzero(first)
            tail_words.append(word[starts])
            tail_times.append(np.diff(starts, append=len(word)))
            tail_sizes[where] = np.bincount(text[starts], minlength=len(rows))
        # All texts of a batch at once, so that long ones find others of their length.
        scores += gru.score(weights, words) / math.log(10)
        items = pa.StructArray.from_arrays(
            [
                pa.array(np.concatenate([np.empty(0, np.uint64), *tail_words]).view(np.int64)),
                pa.array(np.concatenate([np.empty(0, np.int64), *tail_times]).astype(np.int32)),
            ],
            names=["word", "times"],
        )
        offsets = pa.array(np.concatenate([[0], np.cumsum(tail_sizes)]).astype(np.int32))
        return {
            "n_tokens": n_tokens,
            "head_known": known,
            "head_base": base,
            "head_score": scores,
            "tail": pa.ListArray.from_arrays(offsets, items),
        }

    return run


def lm_scores(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: ``key``, held_out, n_tokens, n_known, train_tokens, base_score and score."""
    rows = df.select(F.col(key).alias("key"), F.col(text).alias("text"), held_out(key).alias("held_out"))
    training = rows.filter(~F.col("held_out")).select("text")
    stored = count_words(training)
    counts = head_counts(stored)
    weights = gru.initial(counts.vocabulary_counts)
    for turn in range(ROUNDS):
        weights = train_round(training, counts, weights, turn)
    scored = add_columns(rows, ["text"], _SCORES, _score_batch(counts, weights), drop=True)
    # Stored with its row numbers, so that they stay the same.
    scored = materialize(scored.withColumn("row", F.monotonically_increasing_id()), "scored")
    tail = scored.select("row", F.inline("tail")).join(stored, "word", "left").withColumn("n", F.coalesce("n", F.lit(0)))

    def logs(total: float) -> Column:
        return F.sum(F.col("times") * F.log10((F.col("n") + 0.5) / F.lit(float(total))))

    per_row = tail.groupBy("row").agg(
        F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("tail_known"),
        logs(counts.n_tokens + 0.5 * (counts.n_distinct + 1)).alias("tail_base"),
        logs(counts.n_other + 0.5 * (counts.distinct_other + 1)).alias("tail_score"),
    )
    return scored.drop("tail").join(per_row, "row", "left").select(
        F.col("key").alias(key),
        "held_out",
        "n_tokens",
        (F.col("head_known") + F.coalesce("tail_known", F.lit(0))).alias("n_known"),
        F.lit(counts.n_tokens).cast("long").alias("train_tokens"),
        (F.col("head_base") + F.coalesce("tail_base", F.lit(0.0))).alias("base_score"),
        (F.col("head_score") + F.coalesce("tail_score", F.lit(0.0))).alias("score"),
    )
