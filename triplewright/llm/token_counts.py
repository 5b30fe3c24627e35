"""Token counts through a digest cache.

A cache is a stored table (tokenizer, content, n_tokens): the digest of the tokenizer file
and its settings, and the digest of a content after the tokenizer's own text normalisation.
Contents are joined to stored counts; only distinct misses are encoded, and their counts are
appended. A run that fails before its append leaves the cache as it was; what two runs
append twice is read as one.

A plain byte-level BPE file, whose merges are numbered in their order, is counted by an encoder
that works on ranks alone: the same ids as the file's own library, special strings included, in a
fraction of its time. All other files go to their libraries.

Defined results: a null text counts as an empty one (0 bytes, 0 tokens). Equal texts are
encoded once, rows are kept as they are, repeated rows included. Result columns replace
input columns of the same names.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from triplewright.llm.alignment import byte_characters
from triplewright.llm.batches import Columns, add_columns

CACHE_SCHEMA = "tokenizer string, content string, n_tokens long"
# Characters encoded in one call of the library.
CALL_CHARS = 1 << 20
# Fixed value: how byte-level files cut a text into pieces, unless they bring a pattern of their own.
BYTE_LEVEL_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def rank_counter(path: str) -> Callable[[list[str]], list[int]] | None:
    """Counts tokens of a plain byte-level BPE file by ranks; None for any other file."""
    with open(path, encoding="utf-8") as file:
        stored = json.load(file)
    model, cut = stored["model"], stored.get("pre_tokenizer") or {}
    plain = (
        model.get("type", "BPE") == "BPE"
        and not any(model.get(name) for name in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix"))
        and not any(model.get(name) for name in ("fuse_unk", "byte_fallback", "ignore_merges"))
        and stored.get("normalizer") is None
        and (cut.get("type"), cut.get("add_prefix_space"), cut.get("use_regex", True)) == ("ByteLevel", False, True)
        and all(t["special"] and not any(t[x] for x in ("single_word", "lstrip", "rstrip")) for t in stored["added_tokens"])
    )
    if not plain:
        return None
    vocabulary, byte_of = model["vocab"], byte_characters()
    special = {token["content"]: token["id"] for token in stored["added_tokens"]}
    merged = [vocabulary["".join(pair.split(" ") if isinstance(pair, str) else pair)] for pair in model["merges"]]
    if any(a >= b for a, b in zip(merged, merged[1:])) or len(vocabulary.keys() - special.keys()) != 256 + len(merged):
        return None
    import tiktoken

    ranks = {bytes(byte_of[c] for c in token): i for token, i in vocabulary.items() if token not in special}
    encoder = tiktoken.Encoding("file", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=ranks, special_tokens=special)

    def count(text: str) -> int:
        if any(name in text for name in special):
            return len(encoder.encode(text, allowed_special="all"))
        return len(encoder.encode_ordinary(text))

    return lambda texts: [count(text) for text in texts]


@lru_cache(maxsize=4)
def counter(path: str) -> Callable[[list[str]], list[int]]:
    """Counts tokens with the library that a tokenizer file belongs to."""
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(ids) for ids in model.encode(texts, num_threads=1)]
    if by_rank := rank_counter(path):
        return by_rank
    return library_counter(path)


def library_counter(path: str) -> Callable[[list[str]], list[int]]:
    """Counts tokens with the library of a .json file."""
    import tokenizers

    tokenizer = tokenizers.Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return lambda texts: [len(e.ids) for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


def tokenizer_version(path: str, settings: str = "no special tokens, no truncation, no padding") -> str:
    """Digest of a tokenizer file and of how it is used."""
    with open(path, "rb") as file:
        return hashlib.sha256(file.read() + settings.encode()).hexdigest()


def read_cache(spark: SparkSession, path: str, version: str) -> DataFrame:
    """(content, n_tokens) of one tokenizer version; empty before the first append."""
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    exists = hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop_path)
    stored = spark.read.schema(CACHE_SCHEMA).parquet(path) if exists else spark.createDataFrame([], CACHE_SCHEMA)
    return stored.filter(F.col("tokenizer") == version).drop("tokenizer").dropDuplicates(["content"])


def _count_all(path: str) -> Callable[[list[str]], Columns]:
    def run(texts: list[str]) -> Columns:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        count, counts = counter(path), []
        while len(counts) < len(texts):
            at, end, size = len(counts), len(counts), 0
            while end < len(texts) and (end == at or size + len(texts[end]) <= CALL_CHARS):
                size += len(texts[end])
                end += 1
            counts += count(texts[at:end])
        return {"n_tokens": counts}

    return run


def count_tokens(
    df: DataFrame,
    path: str,
    cache: str,
    text: str = "text",
    normalise: Callable[[Column], Column] = lambda content: content,
) -> DataFrame:
    """Add ``n_bytes`` and ``n_tokens`` of ``text``; drop the text.

    ``normalise`` must change nothing the tokenizer tells apart; without one, as for a
    tokenizer that has no normaliser, contents are compared as they are.
    """
    spark, version = df.sparkSession, tokenizer_version(path)
    content = normalise(F.coalesce(F.col(text), F.lit("")))
    rows = (
        df.drop("n_bytes", "n_tokens", "content")
        .withColumn("n_bytes", F.coalesce(F.octet_length(text), F.lit(0)).cast("long"))
        .withColumn("content", F.sha2(content, 256))
        .drop(text)
    )
    misses = (
        df.select(F.sha2(content, 256).alias("content"), content.alias("text"))
        .join(read_cache(spark, cache, version), "content", "left_anti")
        .dropDuplicates(["content"])
    )
    (
        add_columns(misses, ["text"], "n_tokens long", _count_all(path), drop=True)
        .select(F.lit(version).alias("tokenizer"), "content", "n_tokens")
        .write.mode("append")
        .parquet(cache)
    )
    # One count per content: copies of a content are split over tasks by adaptive execution.
    return rows.join(read_cache(spark, cache, version), "content").drop("content")
