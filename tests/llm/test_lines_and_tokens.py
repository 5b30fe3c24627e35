"""Line removal, spelling variants and tokenizer alignment, against plain Python and the libraries."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import sentencepiece
import tokenizers
from pyspark.sql import functions as F

from tests.llm import brute
from tests.llm.conftest import ODD, SF_DIR
from triplewright.llm import alignment, line_dedup, queries, spelling

LINES = [
    (1, "A line that is long enough\nshort\nunique line of the first one"),
    (2, "  a LINE that is long enough \nshort\n\n"),
    (3, "A line that is long enough\nA line that is long enough\nÄ line that is long enough"),
    (3, "A line that is long enough\nother words than before here"),
    (4, "ä line that is long enough\nother words than before here"),
    (None, "other words than before here\nshort"),
    (None, "seen only without an id at all"),
    (None, "seen only without an id at all"),
    (None, "seen only without an id at all"),
    (5, "éééééééééé ééééééééé\n" * 3),
    (6, "éééééééééé ééééééééé\tx"),
    (7, "éééééééééé ééééééééé\n\x85"),
    (8, "\x0b\x0céééééééééé ééééééééé\r\nx\n" + "y" * 50_000),
    *((100 + i, "in nearly every document\n" + "own line of number " + str(i)) for i in range(40)),
    *((200, "in nearly every document") for _ in range(3)),
]


def line_rows(spark, rows):
    return spark.createDataFrame([(*row, 9, "z") for row in rows], "doc_id long, text string, n_lines int, shard string").repartition(3)


@pytest.mark.parametrize("resident", [line_dedup.RESIDENT_BYTES, -1])
def test_repeated_lines_equal_brute_force(spark, monkeypatch, resident):
    monkeypatch.setattr(line_dedup, "SHARD_KEYS", 2)
    monkeypatch.setattr(line_dedup, "BLOCK_BYTES", 400)
    rows = LINES + [(key, text) for key, text, _ in ODD]
    found = line_dedup.drop_repeated_lines(line_rows(spark, rows), resident_bytes=resident)
    assert sorted(found.columns) == ["doc_id", "kept_text", "n_dropped", "n_lines", "shard", "text"]
    got = Counter(map(tuple, found.select("doc_id", "n_lines", "n_dropped", "kept_text").collect()))
    assert got == Counter(brute.line_dedup(rows))
    assert sum(row[2] for row in got) > 40
    empty = line_dedup.drop_repeated_lines(line_rows(spark, rows).limit(0), resident_bytes=resident)
    assert empty.count() == 0


def test_line_query_equals_brute_force_on_both_paths(spark, documents):
    rows = [(key, row["text"]) for key, row in documents.items()]
    wanted = sorted((key, n, lost, hashlib.sha256(kept.encode()).hexdigest()) for key, n, lost, kept in brute.line_dedup(rows))
    assert sorted(map(tuple, queries.op11_line_dedup(spark, SF_DIR).collect())) == wanted
    table = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text")
    routed = line_dedup.drop_repeated_lines(table, resident_bytes=-1)
    routed = routed.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256))
    assert sorted(map(tuple, routed.collect())) == wanted


@pytest.mark.parametrize("n", [0, 1, 2, 63, 64, 1000, 50_000])
def test_perfect_hash_numbers_keys_without_gaps(n):
    rng = np.random.default_rng(n)
    high, low = rng.integers(0, 1 << 63, (2, n)).astype(np.uint64)
    order = line_dedup.PerfectHash.of(high, low)
    assert sorted(order.numbers(high, low).tolist()) == list(range(n))
    assert len(order.words) * 64 <= 8 * n + 64 * 20  # about four bits a key
    others = order.numbers(high + np.uint64(1), low)
    assert others.min(initial=-1) >= -1 and others.max(initial=-1) < max(n, 1)


def test_shards_tell_other_keys_apart():
    rng = np.random.default_rng(1)
    high, low, other_high, other_low = rng.integers(0, 1 << 63, (4, 5000)).astype(np.uint64)
    shard = line_dedup.Shard(line_dedup._pack(0, high, low, np.arange(5000), np.arange(5000) * 7))
    at = shard.probe(high, low)
    assert np.array_equal(shard.counts[at], np.arange(5000)) and np.array_equal(shard.holders[at], np.arange(5000) * 7)
    assert (shard.probe(other_high, other_low) == -1).all()


# Spelling


def variants(rows):
    return {row["word"]: (row["form"], row["root"], row["n"], row["n_near"], row["form_n"]) for row in rows}


def test_spelling_query_equals_brute_force(spark, documents):
    wanted = brute.spelling_variants(brute.spelling_counts([(key, row["text"]) for key, row in documents.items()]))
    found = queries.op12_spelling_variants(spark, SF_DIR).collect()
    assert len(found) == len(wanted) and variants(found) == wanted


@pytest.mark.parametrize("size", [7, 200_000])
def test_variants_of_odd_words_over_many_ranges(spark, monkeypatch, size):
    monkeypatch.setattr(spelling, "RANGE_WORDS", size)
    draw = random.Random(5)
    words = {"".join(draw.choice("aabÿé") for _ in range(draw.randint(1, 7))) for _ in range(400)}
    words |= {"aaaaaa", "aaaaaaa", "aaaaaaaa", "abcdef", "abcdefg", "abcdefgh", "abcdefghi", "x" * 3000, "x" * 3001, "x" * 1500 + "y" + "x" * 1499}
    counts = {word: draw.choice([5, 6, 25, 30, 125, 700, 3600]) for word in sorted(words)}
    table = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(4)
    found = spelling.group_variants(table).collect()
    assert len(found) == len(counts) and variants(found) == brute.spelling_variants(counts)
    assert spelling.group_variants(table.limit(0)).count() == 0


def test_trie_numbers_sort_like_words(spark, monkeypatch):
    monkeypatch.setattr(spelling, "RANGE_WORDS", 3)
    words = ["a", "ab", "abc", "abd", "b", "bcd", "bce", "éa", "éab", "ÿ", "abcdefgh", "abcdefgi", "abcdefgij"]
    table = spark.createDataFrame([(w,) for w in words], "word string")
    nodes = {row["word"]: row["nodes"] for row in spelling.number_trie(table, len(words), F.col("word")).collect()}
    by_prefix = {}
    for word, own in nodes.items():
        assert len(own) == len(word)
        for n, node in enumerate(own, 1):
            assert by_prefix.setdefault(word[:n], node) == node
    assert sorted(by_prefix.values()) == list(range(1, len(by_prefix) + 1))
    assert sorted(words, key=lambda w: nodes[w][-1]) == sorted(words)


def test_words_of_odd_texts(spark, odd):
    repeated = odd.unionByName(odd).unionByName(odd.withColumn("text", F.upper("text")))
    rows = [(row["doc_id"], row["text"]) for row in repeated.collect()]
    counts = brute.spelling_counts(rows)
    found = {row["word"]: row["n"] for row in spelling.count_words(repeated).collect()}
    assert found == counts and "license" in counts
    assert variants(spelling.spelling_variants(repeated).collect()) == brute.spelling_variants(counts)
    assert spelling.spelling_variants(odd.limit(0)).count() == 0


# Alignment


@pytest.fixture(scope="module")
def libraries():
    side_a = tokenizers.Tokenizer.from_file(queries.TOKENIZER)
    side_a.encode_special_tokens = True
    return side_a, sentencepiece.SentencePieceProcessor(model_file=queries.PIECES)


def library_tokens(libraries, text):
    """[(id, bytes)] of both sides as the libraries and their files have it, or None."""
    if not text:
        return None
    side_a, side_b = libraries
    byte_of = alignment.byte_characters()
    a = [(i, bytes(byte_of[c] for c in side_a.id_to_token(i))) for i in side_a.encode(" " + text, add_special_tokens=False).ids]
    b = []
    for i in side_b.encode(text):
        piece = side_b.id_to_piece(i)
        b.append((i, bytes([int(piece[3:5], 16)]) if side_b.is_byte(i) else piece.replace("▁", " ").encode()))
    whole = (" " + text).encode()
    return (a, b) if all(b"".join(x for _, x in side) == whole for side in (a, b)) else None


STRANGE = [
    "",
    None,
    " ",
    "\n\n",
    "a",
    "▁",
    "words with ▁ inside",
    "<s> and </s>, <unk> <0x41> <|endoftext|>",
    "漢字と仮名 \U0001f600\U0001f468‍\U0001f469 ещё текст",
    "tab\tand  two   spaces \x00 nul   nbsp",
    "a" * 300,
    "naïve café " * 40,
]


def wanted_alignment(libraries, texts):
    found = brute.alignment([library_tokens(libraries, text) for text in texts])
    return [(*row[:6], hashlib.sha256(row[6].encode()).hexdigest() if row[0] else "") for row in found]


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_alignment_query_equals_brute_force(spark, documents, libraries):
    keys = [key for key, row in documents.items() if len(row["text"] or "") < 6000]
    table = spark.read.parquet(f"{SF_DIR}/documents.parquet").filter(F.col("doc_id").isin(keys))
    found = alignment.align(table.select("doc_id", "text"), queries.TOKENIZER, queries.BPE_PATTERN, queries.PIECES)
    wanted = wanted_alignment(libraries, [documents[key]["text"] for key in keys])
    assert {row["doc_id"]: tuple(row[c] for c in COLUMNS) for row in found.collect()} == dict(zip(keys, wanted))


@pytest.mark.parametrize("resident", [alignment.RESIDENT_BYTES, -1])
def test_alignment_of_odd_texts(spark, monkeypatch, libraries, resident):
    monkeypatch.setattr(alignment, "BLOCK_CHARS", 100)
    monkeypatch.setattr(alignment, "BLOCK_LINKS", 50)
    monkeypatch.setattr(alignment, "TASK_PAIRS", 20)
    texts = STRANGE + [text if text is None else text[:3000] for _, text, _ in ODD] + ["a", "a"]
    rows = [(i % 20, text, 1, "z") for i, text in enumerate(texts)]
    table = spark.createDataFrame(rows, "doc_id long, text string, n_links int, __pair string").repartition(3)
    found = alignment.align(table, queries.TOKENIZER, queries.BPE_PATTERN, queries.PIECES, resident_bytes=resident)
    assert sorted(found.columns) == sorted(["doc_id", "__pair", *COLUMNS])
    wanted = wanted_alignment(libraries, texts)
    got = Counter((row["doc_id"], *(row[c] for c in COLUMNS)) for row in found.collect())
    assert got == Counter((row[0], *own) for row, own in zip(rows, wanted))
    assert any(row[0] == 0 for row, text in zip(wanted, texts) if text)  # ▁ does not come back
    assert alignment.align(table.limit(0), queries.TOKENIZER, queries.BPE_PATTERN, queries.PIECES, resident_bytes=resident).count() == 0


def test_rank_encoder_equals_the_library_file(libraries):
    """Every token encodes to itself, merges are numbered in their order, and the library's pattern tells
    the same characters apart: then both encoders agree on all texts."""
    side, library = alignment.byte_level_side(queries.TOKENIZER, queries.BPE_PATTERN), libraries[0]
    texts = [piece.decode() for piece in side.pieces if piece and piece.isascii()]
    texts += ["".join(map(chr, range(start, start + 64))) for start in range(0x20, 0xD7C0, 64)]
    texts += [f"a{chr(c)}1{chr(c)} {chr(c)}{chr(c)}x  {chr(c)}" for c in [*range(0x80, 0x3100), *range(0xA000, 0xAC00), *range(0xFB00, 0x10000), *range(0x10000, 0x20000, 7)]]
    wanted = [e.ids for e in library.encode_batch([" " + text for text in texts], add_special_tokens=False)]
    assert side.encode(texts) == wanted
