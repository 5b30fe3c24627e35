"""Operators that work row by row, against plain Python and the libraries themselves."""

import base64
import hashlib
import json
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import tokenizers

from tests.llm import brute
from tests.llm.conftest import ODD, SF_DIR
from triplewright.llm import bpe, license_rules, licenses, quality, queries, sharding, token_counts
from triplewright.llm.alignment import byte_characters
from triplewright.llm.bpe import Vocabulary
from triplewright.session import scratch_path


@pytest.fixture(scope="module")
def tiktoken_encoding():
    with open(queries.BPE_RANKS, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def expected_bpe(encoding, text):
    ids = np.array(encoding.encode_ordinary(text or ""), dtype="<u4").tobytes()
    return len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()


def test_bpe_equals_the_library(spark, odd, documents, tiktoken_encoding):
    for row in queries.op3_bpe_round_trip(spark, SF_DIR).collect():
        assert row[1:] == expected_bpe(tiktoken_encoding, documents[row["doc_id"]]["text"])
    found = bpe.round_trip(odd, queries.BPE_RANKS, queries.BPE_PATTERN)
    assert found.columns == ["doc_id", "source", "n_words", "shard", "n_tokens", "ids_sha256", "decoded_sha256"]
    got = Counter((r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in found.collect())
    assert got == Counter((key, *expected_bpe(tiktoken_encoding, text)) for key, text, _ in ODD)
    assert bpe.round_trip(odd.limit(0), queries.BPE_RANKS, queries.BPE_PATTERN).count() == 0


def test_bpe_long_matches_merge_in_the_same_order(tiktoken_encoding, monkeypatch):
    words = Vocabulary(queries.BPE_RANKS, public_tokenizers.PATTERN)
    rng = np.random.default_rng(3)
    texts = ["".join(rng.choice(list("abcéß "), size=n)) for n in (1, 5, 40, 300, 3000)] + ["a" * 5000, "ab" * 700]
    for limit in (8, 256):
        monkeypatch.setattr(bpe, "LONGEST_ROW", limit)
        words.remembered.clear()
        for text in texts:
            packed = words.encode(text).tobytes()
            assert np.frombuffer(packed, "<u4").tolist() == tiktoken_encoding.encode_ordinary(text)
            assert words.decode(packed).decode() == text


def test_encode_and_decode_columns(odd):
    ids = bpe.encode(odd, queries.BPE_RANKS, queries.BPE_PATTERN)
    back = bpe.decode(ids, queries.BPE_RANKS, queries.BPE_PATTERN).collect()
    assert all(bytes(row["decoded"]) == (row["text"] or "").encode() for row in back)


def test_token_counts_use_and_fill_the_cache(spark, odd, documents):
    tokenizer = tokenizers.Tokenizer.from_file(queries.TOKENIZER)

    def expected(text):
        return len((text or "").encode()), len(tokenizer.encode(text or "", add_special_tokens=False).ids)

    for row in queries.op5_token_counts(spark, SF_DIR).collect():
        n_bytes, n_tokens = expected(documents[row["doc_id"]]["text"])
        assert tuple(row) == (row["doc_id"], n_bytes, n_tokens, n_tokens > 1024)
    cache = scratch_path(spark, "cache")
    special = spark.createDataFrame([(1, "a<|endoftext|>b")], "doc_id long, text string")
    for df, n_cached in ((odd, 9), (odd, 9), (special, 10)):
        counted = token_counts.count_tokens(df, queries.TOKENIZER, cache)
        got = Counter((r["doc_id"], r["n_bytes"], r["n_tokens"]) for r in counted.collect())
        assert got == Counter((r["doc_id"], *expected(r["text"])) for r in df.collect())
        assert spark.read.parquet(cache).count() == n_cached
    assert token_counts.count_tokens(odd.limit(0), queries.TOKENIZER, cache).count() == 0


def test_ranks_count_what_the_library_counts():
    by_rank, by_library = token_counts.rank_counter(queries.TOKENIZER), token_counts.library_counter(queries.TOKENIZER)
    end = "<|endoftext|>"
    texts = [text or "" for _, text, _ in ODD] + [end, f"a{end} b", f"{end}{end}\n\n {end}", "<|endoftext", f"  {end}  x", "'S 'll"]
    texts += [f"a{chr(c)}1{chr(c)} {chr(c)}{chr(c)}  {chr(c)}x" for c in [*range(0x3100), *range(0xF900, 0x10000), *range(0x10000, 0x1F000, 5)]]
    with open(queries.TOKENIZER, encoding="utf-8") as file:
        stored = json.load(file)
    special = {token["content"] for token in stored["added_tokens"]}
    byte_of = byte_characters()
    pieces = [bytes(byte_of[c] for c in token) for token in stored["model"]["vocab"] if token not in special]
    texts += [piece.decode() for piece in pieces if b"\xef\xbf\xbd" not in piece.decode("utf-8", "replace").encode()]
    assert by_rank(texts) == by_library(texts)


def test_other_files_go_to_their_library(tmp_path):
    assert token_counts.rank_counter(public_tokenizers.path("word_bpe_49k.json")) is None
    with open(queries.TOKENIZER, encoding="utf-8") as file:
        stored = json.load(file)
    stored["model"]["merges"][5:7] = stored["model"]["merges"][6], stored["model"]["merges"][5]
    (tmp_path / "other.json").write_text(json.dumps(stored))
    assert token_counts.rank_counter(str(tmp_path / "other.json")) is None
    assert token_counts.counter(str(tmp_path / "other.json"))(["hello there"]) == [2]


def test_sentencepiece_models_are_counted(spark):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    df = spark.createDataFrame([(1, "Hello there"), (2, None)], "doc_id long, text string")
    got = {r["doc_id"]: r["n_tokens"] for r in token_counts.count_tokens(df, path, scratch_path(spark, "c")).collect()}
    assert got == {1: len(model.encode("Hello there")), 2: 0}


def test_quality_measures_and_policies(odd):
    ledger = quality.ledger(odd)
    assert "text" not in ledger.columns and ledger.columns.count("n_words") == 1
    rows = ledger.collect()
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    got = Counter((r["doc_id"], *(r[n] for n in names), r["failed_bits"] & 3 != 0) for r in rows)
    assert got == Counter((key, *brute.quality(text)) for key, text, _ in ODD)
    kept = [r for r in quality.apply_policy(ledger, 1).collect() if r["kept"]]
    assert all(r["failed_bits"] & quality.policy_mask(1) == 0 for r in kept)
    assert quality.ledger(odd.limit(0)).count() == 0


def test_quality_ablation_counts_rows(spark):
    ledger = spark.createDataFrame([(b,) for b in (0, 1, 1, 2, 3, 4, 256)], "failed_bits long")
    got = {r["rule"]: (r["n_failed"], r["n_only"], r["n_removed"]) for r in quality.ablation(ledger, 1).collect()}
    assert got == {"few_words": (3, 2, 4), "repeated_words": (2, 1, 4)}


def test_quality_keeps_clean_documents(spark):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    rows = queries.op10_quality_ledger(spark, SF_DIR).collect()
    good = [r["kept"] for r in rows if labels.get(r["doc_id"]) == 1 and not r["base_failed"]]
    assert good and all(good)


def test_license_bases(spark, odd, documents):
    names = ["n_words", "n_base", "first_word", "last_word", "base_labels"]
    for row in queries.op4_license_rules(spark, SF_DIR).collect():
        assert tuple(row[n] for n in names) == brute.licenses(documents[row["doc_id"]]["text"])
    found = licenses.scan_licenses(odd)
    got = Counter((r["doc_id"], *(r[n] for n in names)) for r in found.collect())
    assert got == Counter((key, *brute.licenses(text)) for key, text, _ in ODD)
    assert licenses.scan_licenses(odd.limit(0)).count() == 0


def test_license_suppression(spark):
    texts = {
        1: "Licensed under the Apache License, Version 2.0.",
        2: "not a licence at all",
        3: "SPDX-License-Identifier: MIT",
        4: "Permission is hereby granted, free of charge, to any person obtaining a copy. All rights reserved.",
        5: "CC BY-NC 4.0 and mit license mit license",
    }
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r["doc_id"]: (r["labels"], r["score"]) for r in licenses.scan_licenses(df).collect()}
    assert got == {
        1: ("apache,apache-2.0", 0.95),
        2: ("", 0.0),
        3: ("mit", 1.0),
        4: ("mit,proprietary", 0.95),
        5: ("cc-by,cc-by-nc-4.0,mit", 0.95),
    }


def test_license_gates_cover_all_rules():
    keywords = [rule.keyword for rule in license_rules.RULES] + list(licenses.BASE)
    assert len(license_rules.RULES) > 200
    assert all(any(gate in keyword for gate in license_rules.GATE) for keyword in keywords)
    assert all(any(raw in gate for raw in license_rules.RAW_GATE) for gate in license_rules.GATE)


def spellings(regex):
    """All strings that a rule's regex matches, of open classes and long repeats only examples."""

    def of(parsed):
        found = [""]
        for op, value in parsed:
            name = str(op)
            if name == "LITERAL":
                more = [chr(value)]
            elif name == "NOT_LITERAL":
                more = ["x"]
            elif name == "IN":
                more = [chr(v) if str(o) == "LITERAL" else chr(v[0]) for o, v in value]
            elif name == "SUBPATTERN":
                more = of(value[-1])
            elif name == "BRANCH":
                more = [text for branch in value[1] for text in of(branch)]
            else:
                assert name == "MAX_REPEAT", name
                least, most, inner = value
                more = [text * n for n in sorted({least, min(most, least + 1)}) for text in of(inner)]
            found = [text + end for text in found for end in dict.fromkeys(more)]
        return found

    return of(re._parser.parse(regex))


def license_labels_brute(text):
    """Labels of all rules' matches that stay, without any keyword."""
    words, matches = f" {text} ", []
    for i, rule in enumerate(license_rules.RULES):
        for match in re.finditer(f"(?<= )(?:{rule.regex})(?= )", words):
            matches.append((match.start(), match.end(), rule.priority, -i, rule.label))
    stay = {
        label
        for begin, end, priority, order, label in matches
        if not any(
            b <= begin and end <= e and p >= priority and (b, e, p, o) != (begin, end, priority, order)
            and ((b, e) != (begin, end) or p > priority or o > order)
            for b, e, p, o, _ in matches
        )
    }
    return ",".join(sorted(stay | {label for phrase, label in licenses.BASE.items() if f" {phrase} " in words}))


def test_license_keywords_are_in_every_spelling(spark):
    texts = set()
    for rule in license_rules.RULES:
        own = spellings(rule.regex)
        assert [text for text in own if rule.keyword not in text] == [], rule
        texts |= set(own)
    texts = sorted(texts)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(8)
    got = {r["doc_id"]: r["labels"] for r in licenses.scan_licenses(df).collect()}
    wrong = [(text, got[i]) for i, text in enumerate(texts) if got[i] != license_labels_brute(text)]
    assert wrong == []


def test_license_hyphenated_creative_commons(spark):
    texts = {1: "Creative Commons Attribution-Share Alike 3.0", 2: "under the Creative Commons Attribution-Non-Commercial 4.0 terms"}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r["doc_id"]: r["labels"] for r in licenses.scan_licenses(df).collect()}
    assert got == {1: "cc-by-sa-3.0", 2: "cc-by-nc-4.0"}


def test_shards_are_near_equal_and_gapless(spark, odd, documents):
    rows = queries.op9_virtual_slots(spark, SF_DIR).collect()
    slots, loads = defaultdict(list), Counter()
    for row in rows:
        data = (documents[row["doc_id"]]["text"] or "").encode()
        assert (row["size"], row["text_crc32"]) == (len(data) + 8, zlib.crc32(data))
        slots[row["shard"]].append(row["slot"])
        loads[row["shard"]] += row["size"]
    assert len(rows) == len(documents)
    assert all(sorted(own) == list(range(len(own))) for own in slots.values())
    assert max(loads.values()) - min(loads.values()) <= max(row["size"] for row in rows)
    table = sharding.shard_table(odd, 4)
    assert table.count() == len(ODD)
    assert sharding.shard_table(odd.limit(0), 4).count() == 0


def test_rebalancing_edits_few_slots():
    sizes = {slot: 100 + slot % 7 for slot in range(1000)}
    now = sharding.first_map(sizes, 10, 1000)
    grown = sharding.rebalanced_map(now, sizes, 11)
    assert {grown[s] for s in now if grown[s] != now[s]} == {10}
    shrunk = sharding.rebalanced_map(grown, sizes, 10)
    assert set(shrunk.values()) == set(range(10))
    assert all(shrunk[s] == grown[s] for s in grown if grown[s] < 10)
