"""Operators over whole tables, against brute force."""

import math
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.compare import SPARK_TYPES, database, differences
from tests.llm import brute
from tests.llm.conftest import ODD, SF_DIR
from triplewright import session
from triplewright.llm import components, lm_scoring, mixing, near_dups, nn_descent, queries, warc
from triplewright.llm.oracle import ORACLE


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name, monkeypatch):
    monkeypatch.setitem(SPARK_TYPES, "boolean", "BOOLEAN")
    assert differences(queries.QUERIES[name](spark, SF_DIR), database(SF_DIR), ORACLE[name]) == []


def pages_brute(rows):
    first = {}
    for key, _, html in rows:
        if key is not None and len((html or "").encode()) >= 100:
            first[html] = min(first.get(html, key), key)
    for key, _, html in rows:
        target = first.get(html)
        revisit = target is not None and (key is None or key > target)
        yield key, len((html or "").encode()), "revisit" if revisit else "response", target if revisit else None


def test_warc_round_trip_of_odd_pages(spark):
    rows = [
        (5, "http://a.com/x", "y" * 200),
        (3, "http://a.com/x#f", "y" * 200),
        (3, "http://a.com/x", "y" * 200),
        (None, None, "y" * 200),
        (None, "http://b/", "z" * 150),
        (7, "", None),
        (8, "HTTP://U:p@WWW.A.com:80?q\n\t", "é" * 60),
        (9, "http://a.com/x", "é" * 60),
        (None, None, None),
    ]
    df = spark.createDataFrame([(*row, 1) for row in rows], "page_id long, url string, html string, key int")
    entries, manifest = warc.archive_pages(df)
    read = warc.read_back(df, manifest).collect()
    got = Counter((r["page_id"], r["payload_bytes"], r["record_type"], r["refers_to"]) for r in read)
    assert got == Counter(pages_brute(rows))
    assert {bytes(r["payload"]) for r in read if r["payload"] is not None} == {(h or "").encode() for _, _, h in rows}
    _, nothing = warc.archive_pages(df.limit(0))
    assert warc.read_back(df, nothing).count() == 0


def test_index_with_small_blocks_finds_every_capture(spark):
    rows = [(i, f"http://h{i % 3}.org/{'same' if i % 2 else i}", f"page {i}") for i in range(200)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    entries = warc.write_archives(warc.with_revisits(df), warc.scratch_path(spark, "a"))
    manifest = warc.write_index(entries, warc.scratch_path(spark, "i"), block_lines=7)
    found = warc.read_back(df.filter("page_id % 2 = 1"), manifest).collect()
    assert sorted(r["page_id"] for r in found) == list(range(1, 200, 2))


def test_near_duplicates_equal_brute_force(spark, odd, documents):
    rows = [(key, row["text"]) for key, row in documents.items()]
    got = queries.op2_setsketch_dedup(spark, SF_DIR).collect()
    assert Counter((r[0], r[1], r[2]) for r in got) == Counter(brute.near_duplicates(rows))
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)
    found = near_dups.near_duplicates(odd)
    got = Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found.collect())
    assert got == Counter(brute.near_duplicates([(key, text) for key, text, _ in ODD]))
    assert near_dups.near_duplicates(odd.limit(0)).count() == 0


def test_members_that_only_meet_through_rare_shingles(spark):
    """A hub with partners that are similar to each other but not to it, and a shared passage."""
    rng = np.random.default_rng(5)
    base = [f"w{i}" for i in range(60)]
    texts = []
    for i in range(40):
        words = base + [f"own{i}x{j}" for j in range(int(rng.integers(2, 30)))]
        texts.append((i, " ".join(words)))
    df = spark.createDataFrame(texts, "doc_id long, text string")
    got = Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in near_dups.near_duplicates(df).collect())
    assert got == Counter(brute.near_duplicates(texts))


@pytest.mark.parametrize("size", [4, 5])
def test_a_large_group_of_near_copies_around_the_threshold(spark, size, monkeypatch):
    rng = np.random.default_rng(7)
    base, texts = [f"w{i}" for i in range(110)], []
    for i in range(400):
        own = list(base)
        for place in rng.choice(110, size=int(rng.integers(0, 4)), replace=False):
            own[place] = f"x{i}y{place}"
        texts.append((i, " ".join(own)))
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(4)
    compared = []
    real = near_dups.likely_pairs
    monkeypatch.setattr(near_dups, "likely_pairs", lambda pairs, classes: compared.append(pairs.count()) or real(pairs, classes))
    found = near_dups.near_duplicates(df, size=size)
    got = Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found.collect())
    assert got == Counter(brute.near_duplicates(texts, size))
    assert len({component for _, _, component in got}) < 200
    assert sum(compared) < 400 * 399 / 2 / 4, compared


def test_keep_one_row_of_each_component(odd):
    kept = near_dups.keep_one(odd)
    assert kept.columns == odd.columns
    ids = Counter(r["doc_id"] for r in kept.collect())
    assert ids == Counter([1, 2, 3, None, 4, 7, 8, 9, 10])


def test_texts_of_classes_alone_in_their_buckets_are_not_shuffled(spark):
    rows = [(i, f"text number {i} of its own" if i % 40 else "one and the same") for i in range(400)] + [(400, None), (401, " ")]
    source = spark.createDataFrame(rows, "key long, text string")
    members = near_dups.with_class(source.filter("key IN (0, 1, 2, 40)"))
    found = near_dups.texts_of(source, members)
    assert sorted(r["text"] for r in found.collect()) == ["one and the same", "text number 1 of its own", "text number 2 of its own"]
    # The filter's blocks are looked up below the join.
    assert "__block" in found._jdf.queryExecution().optimizedPlan().toString()


def shuffle_files(spark):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    names = disk.getAllBlocks().mkString(" ").split()
    return {name for name in names if name.startswith("shuffle_")}


def left_over(spark, before):
    """Shuffle files that are new and stay; executors delete theirs a moment after a query's end."""
    deadline = time.time() + 10
    while (found := shuffle_files(spark) - before) and time.time() < deadline:
        time.sleep(0.2)
    return found


def test_written_tables_leave_no_shuffle_files(spark):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    rows = spark.range(1000, numPartitions=6).withColumn("k", F.col("id") % 7)
    plain = rows.groupBy("k").count().join(rows, "k")
    before, setting = shuffle_files(spark), spark.conf.get(key, None)
    written = session.materialize(plain, "plain")
    assert left_over(spark, before) == set()
    # Frames may be used again, and the session is as it was.
    assert session.materialize(plain, "plain").count() == written.count() == plain.count() == 1000
    assert spark.conf.get(key, None) == setting


def test_search_for_near_duplicates_leaves_what_its_result_reads(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "shared_folder", lambda spark: str(tmp_path / "scratch"))
    texts = [(i, " ".join(f"w{j}" for j in range(40)) + f" own{i % 20}") for i in range(60)] + [(60, None)]
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    before = shuffle_files(spark)
    found = near_dups.near_duplicates(df)
    assert left_over(spark, before) == set()
    left = [p.name.rsplit("-", 1)[0] for p in (tmp_path / "scratch").iterdir()]
    assert sorted(left) == ["classes", "labels", "sketches"]
    got = Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found.collect())
    assert got == Counter(brute.near_duplicates(texts))


def test_similarity_estimates_are_close():
    from triplewright.llm.words import mix

    rng = np.random.default_rng(1)
    for similarity in (0.3, 0.8, 0.95):
        n, shared = 2000, round(2 * 2000 * similarity / (1 + similarity))
        pool = mix(rng.integers(0, 2**63, size=2 * n - shared, dtype=np.uint64))
        a, b = pool[:n], pool[n - shared :]
        keys, begins = np.concatenate([a, b]), np.array([0, n, 2 * n])
        x, y = near_dups.registers(keys, begins).astype(int)
        found = near_dups.estimate_similarity(*(np.array([v]) for v in ((x > y).sum(), (x < y).sum(), n, n)))
        assert abs(found[0] - similarity) < 0.16


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(20)] + [(100, i) for i in range(101, 120)] + [(7, 7)]
    got = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(21)} | {i: 100 for i in range(100, 120)}


def test_mix_meets_targets(spark, odd, documents):
    size = {key: len(brute.words(row["text"])) for key, row in documents.items()}
    sizes = Counter()
    for key, row in documents.items():
        sizes[row["source"]] += size[key]
    goal, taken = brute.targets(sizes), Counter()
    rows = queries.op6_pareto_mix(spark, SF_DIR).collect()
    for row in rows:
        source = documents[row["doc_id"]]["source"]
        assert (row["size"], row["source_size"]) == (size[row["doc_id"]], sizes[source])
        assert row["target"] == pytest.approx(goal[source]) and row["taken"] <= 3 * row["size"]
        taken[source] += row["taken"]
    # With ten documents a source, half a long document is as near as whole copies come.
    longest = {s: max(size[key] for key, row in documents.items() if row["source"] == s) for s in goal}
    assert all(abs(taken[s] - goal[s]) <= longest[s] / 2 + 5 for s in goal)
    again = queries.op6_pareto_mix(spark, SF_DIR).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, rows))
    mix = mixing.pareto_mix(odd)
    assert mix.count() == len(ODD)
    assert mixing.pareto_mix(odd.limit(0)).count() == 0


def test_repeated_records_are_drawn_one_by_one(spark):
    rows = [(1, "a b c d e", "s")] * 300 + [(2, "f g", "t")] * 300
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    taken = Counter()
    for row in mixing.pareto_mix(df).collect():
        taken[row["source"]] += row["copies"] * row["size"]
    goal = brute.targets({"s": 1500, "t": 600})
    assert all(abs(taken[s] - goal[s]) <= 5 for s in goal)
    copies = mixing.mixed_rows(df)
    assert copies.columns == df.columns and copies.filter("source = 's'").count() * 5 == taken["s"]


def test_copies_of_a_hot_record_are_dealt_over_tasks(spark):
    hot = spark.range(0, 20_000, 1, 8).select(F.lit(1).cast("long").alias("doc_id"), F.lit("a b c").alias("text"), F.lit("s").alias("source"))
    fields = "doc_id long, text string, source string"
    other = spark.createDataFrame([(2, "x y", "t"), (None, "x", "t"), (None, "x", "t"), (3, None, "s"), (3, None, "s")], fields)
    df = hot.union(other)
    wanted = Counter()
    for row in mixing.pareto_mix(df).collect():
        wanted[row["doc_id"]] += row["copies"] if row["size"] else 1
    mixed = mixing.mixed_rows(df)
    assert mixed.columns == df.columns
    got = Counter(row["doc_id"] for row in mixed.collect())
    assert got == +wanted and got[3] == 2 and got[1] > 10_000


def lm_brute(rows):
    tokens = [[*brute.words((text or "").translate(brute.LOWER)), None] for _, text in rows]
    out = [zlib.crc32(("" if key is None else str(key)).encode()) % 5 == 1 for key, _ in rows]
    counts = Counter(t for own, held in zip(tokens, out) if not held for t in own)
    n, v = sum(counts.values()), len(counts)
    for (key, _), own, held in zip(rows, tokens, out):
        base = sum(math.log10((counts[t] + 0.5) / (n + 0.5 * (v + 1))) for t in own)
        yield key, held, len(own), sum(counts[t] > 0 for t in own), n, round(base, 4)


@pytest.mark.parametrize("head", [1 << 18, 300])
def test_language_model_base_scores(spark, odd, documents, monkeypatch, head):
    monkeypatch.setattr(lm_scoring, "HEAD_WORDS", head)
    for df in (spark.read.parquet(f"{SF_DIR}/documents.parquet"), odd):
        rows = [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
        found = lm_scoring.lm_scores(df).collect()
        assert Counter((*r[:5], round(r["base_score"], 4)) for r in found) == Counter(lm_brute(rows))
        assert all(math.isfinite(r["score"]) and r["score"] <= 0 for r in found)
    assert lm_scoring.lm_scores(odd.limit(0)).count() == 0


def test_recurrent_model_trains_on_every_segment_once():
    rng = np.random.default_rng(3)
    for n in [0, 1, 5, 127, 128, 129, 1000, 20_000] + list(range(2, 60)):
        hashes = rng.integers(0, 1 << 63, n).astype(np.uint64)
        words = np.arange(n + 1)
        pieces = [piece for turn in range(lm_scoring.ROUNDS) for _, piece in lm_scoring._segments(words, hashes, turn)]
        assert all(len(piece) <= lm_scoring.SEGMENT for piece in pieces)
        assert np.array_equal(np.sort(np.concatenate(pieces)), words)


def test_recurrent_model_gradients_and_sums():
    from triplewright.llm import gru

    rng = np.random.default_rng(0)
    weights = gru.initial(rng.random(gru.N_WORDS))
    state = np.array(rng.standard_normal((1, gru.N_HIDDEN)), dtype=np.float32)
    every = gru.log_probabilities(weights, np.repeat(state, gru.N_WORDS, axis=0), np.arange(gru.N_WORDS))
    assert np.exp(every).sum() == pytest.approx(1, abs=1e-4)
    texts = [np.append(np.tile([5, 9, 700], 40), gru.END) for _ in range(8)]
    trainer = gru.Trainer(weights)
    for _ in range(20):
        trainer.train([(gru.END, text) for text in texts])
    assert gru.score(trainer.w, texts).sum() > gru.score(weights, texts).sum() / 4
    one_by_one = [gru.score(trainer.w, [text])[0] for text in texts]
    assert np.allclose(one_by_one, gru.score(trainer.w, texts), rtol=1e-4)
    packed = gru.unpack(gru.pack(weights))
    assert all(np.array_equal(packed[name], weights[name]) for name in weights)


def test_recurrent_model_beats_the_base_on_held_out_texts(spark):
    rows = lm_scoring.lm_scores(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).filter("held_out").collect()
    assert sum(r["score"] for r in rows) > sum(r["base_score"] for r in rows)


def test_nearest_neighbours_recall_and_scores(spark):
    table = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()
    x = np.array([r["embedding"] for r in table], dtype=np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    ids = np.array([r["vec_id"] for r in table])
    found = Counter()
    for row in queries.op7_nn_descent(spark, SF_DIR).collect():
        a, b = np.flatnonzero(ids == row["query_id"])[0], np.flatnonzero(ids == row["vec_id"])[0]
        assert row["score"] == pytest.approx(float(x[a] @ x[b]), abs=1e-9)
        others = np.delete(x @ x[a], a)
        found[bool(row["score"] >= np.sort(others)[-5] - 1e-9)] += 1
    assert found[True] >= 0.9 * sum(found.values()) and sum(found.values()) == 5 * sum(ids % 50 == 0)


def test_neighbours_in_clusters_and_groups_of_copies(spark, monkeypatch):
    monkeypatch.setattr(nn_descent, "ENTRIES", 8)
    monkeypatch.setattr(nn_descent, "ENTRIES_PER_ROOT", 0, raising=False)
    rng = np.random.default_rng(11)
    centres = rng.standard_normal((30, 48))
    x = np.concatenate(
        [np.repeat(centres[:10], 40, axis=0)]
        + [centre + 0.02 * rng.standard_normal((40, 48)) for centre in centres[10:]]
    )
    df = spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(x)], "vec_id long, embedding array<double>")
    found = nn_descent.nearest(df.repartition(4), "vec_id % 20 = 0", 5).collect()
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    hits = 0
    for row in found:
        others = np.delete(x @ x[row["query_id"]], row["query_id"])
        hits += row["score"] >= np.sort(others)[-5] - 1e-6
    assert len(found) == 5 * 60 and hits >= 0.98 * len(found), hits / len(found)


def test_copies_settle_and_ties_go_to_the_smallest_ids(spark):
    rng = np.random.default_rng(3)
    x = rng.standard_normal((1500, 16))
    x[500:] = x[500]
    order = rng.permutation(1500)
    df = spark.createDataFrame([(int(i), x[i].tolist()) for i in order], "vec_id long, embedding array<double>")
    found = nn_descent.nearest(df.repartition(4), "vec_id % 50 = 0", 5).collect()
    answers = {}
    for row in sorted(found, key=lambda r: r["rank"]):
        answers.setdefault(row["query_id"], []).append(row["vec_id"])
    assert set(answers) == set(range(0, 1500, 50)) and all(len(own) == 5 for own in answers.values())
    for query, own in answers.items():
        if query >= 500:
            assert own == [i for i in range(500, 507) if i != query][:5]
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    hits = 0
    for query in range(0, 500, 50):
        scores = unit @ unit[query]
        best = sorted((i for i in range(1500) if i != query), key=lambda i: (-round(scores[i], 12), i))[:5]
        hits += len(set(best) & set(answers[query]))
    assert hits >= 48


def test_extreme_and_repeated_vectors(spark):
    rows = [(0, [1e-170, 0.0]), (1, [1e200, 1e200]), (2, [3e200, 0.0]), (3, [5e-324, 1e-300]), (50, [1e-300, 1e-300])]
    rows += [(50, [1e-300, 1e-300]), (4, [1.5, 1.5]), (4, [1.5, 1.5])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in nn_descent.nearest(df, "vec_id % 50 = 0", 5).collect():
        assert np.isfinite(r["score"])
        got.setdefault((r["query_id"], r["rank"]), []).append((r["vec_id"], round(r["score"], 9)))
    half = round(0.5**0.5, 9)
    assert [got[0, i] for i in range(1, 6)] == [[(2, 1.0)], [(1, half)], [(4, half)], [(4, half)], [(50, half)]]
    # Both rows of id 50 are asked, each finds the other one.
    # Parallel vectors of other lengths tie but for rounding in the last bit.
    four = [got[50, i] for i in range(1, 5)]
    assert sorted(four) == [[(1, 1.0)] * 2, [(4, 1.0)] * 2, [(4, 1.0)] * 2, [(50, 1.0)] * 2]


def test_a_table_of_copies_only(spark):
    df = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(60)], "vec_id long, embedding array<double>")
    found = sorted(map(tuple, nn_descent.nearest(df, "vec_id % 50 = 0", 5).select("query_id", "rank", "vec_id").collect()))
    assert found == [(0, i, i) for i in range(1, 6)] + [(50, i, i - 1) for i in range(1, 6)]


def test_odd_vectors_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [3.0, 0.0]), (50, [0.0, 1.0]), (3, None), (4, [0.0, 0.0])]
    rows += [(5, [nan, 1.0]), (6, [None, 1.0]), (7, [inf, 1.0]), (None, [1.0, 1.0]), (8, [1.0]), (100, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = nn_descent.nearest(df, "vec_id % 50 = 0", 5).collect()
    got = {(r["query_id"], r["rank"]): r["vec_id"] for r in found}
    assert got == {(0, 1): 1, (0, 2): 2, (0, 3): 50, (50, 1): 0, (50, 2): 1, (50, 3): 2}
    assert nn_descent.nearest(df.limit(0), "vec_id % 50 = 0", 5).count() == 0


def test_pipeline_stages(spark, documents):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs
        docs = stage(spark, docs, SF_DIR)
        assert docs.columns == corpus_pipeline.COLUMNS
        rows, after = before.collect(), Counter(r["doc_id"] for r in docs.collect())
        if name == "quality_rules":
            assert all(not brute.quality(documents[key]["text"])[5] for key in after)
        if name == "near_duplicates":
            expected = brute.near_duplicates([(r["doc_id"], r["text"]) for r in rows], corpus_pipeline.STAGE_WORDS)
            assert after == Counter(key for key, _, component in expected if key == component)
        if name == "source_mix":
            taken = {r["doc_id"]: r["copies"] for r in mixing.pareto_mix(before).collect() if r["copies"]}
            assert after == Counter(taken)
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).count() == sum(after.values())


def test_equal_registers_are_counted(spark):
    rng = np.random.default_rng(2)
    sketches = rng.integers(0, 2**16, size=(2, near_dups.N_REGISTERS))
    sketches[1, :40] = sketches[0, :40]
    sketches[1, 40:] = sketches[0, 40:] + 1 + 2 * rng.integers(0, 100, size=near_dups.N_REGISTERS - 40)
    a, b = near_dups.prints(sketches)
    df = spark.createDataFrame([(a.tolist(), b.tolist())], "a array<long>, b array<long>")
    assert df.select(near_dups.equal_registers("a", "b")).first()[0] == 40


def test_texts_are_confirmed_a_bounded_number_at_a_time(monkeypatch):
    monkeypatch.setattr(near_dups, "TEXTS_AT_ONCE", 2)
    text = "one two three four five"
    batch = pa.RecordBatch.from_pydict(
        {"a": [b"a"] * 5, "b": [None, b"b", b"c", b"d", b"e"], "part": [0] * 5, "text": [text, text, "other words here and there", text, text]},
        schema=pa.schema([("a", pa.binary()), ("b", pa.binary()), ("part", pa.int64()), ("text", pa.string())]),
    )
    found = list(near_dups._confirm(4)(iter([batch])))
    assert [x.column("b").to_pylist() for x in found] == [[b"b"], [b"d"], [b"e"]]


def test_bucket_members_are_those_of_shared_bands(spark, monkeypatch):
    """Only their rows are shuffled with their classes, all others as bare bands."""
    rng = np.random.default_rng(7)
    sketches = rng.integers(0, 2**16, size=(300, near_dups.N_REGISTERS)).astype(">u2")
    sketches[1, :40] = sketches[0, :40]  # ten bands
    sketches[2, 20:60] = sketches[0, 20:60]  # ten, five of them with the first two
    rows = [(bytes([i // 256, i % 256]), i + 4, sketches[i].tobytes()) for i in range(300)]
    classes = spark.createDataFrame(rows, "class binary, n_shingles long, registers binary")
    searched = []
    real = near_dups.existence_join

    def spying(left, right, *args, **options):
        searched.append((left.count(), right.count()))
        return real(left, right, *args, **options)

    monkeypatch.setattr(near_dups, "existence_join", spying)
    found = near_dups.bucket_members(classes).collect()
    by_band = defaultdict(list)
    for row in found:
        by_band[row["band"]].append((bytes(row["class"]), bytes(row["centre"]), row["n_shingles"]))
    assert searched == [(300 * near_dups.N_BANDS, 15)]
    wanted = [{0, 1}] * 5 + [{0, 1, 2}] * 5 + [{0, 2}] * 5
    assert sorted(sorted(n - 4 for _, _, n in bucket) for bucket in by_band.values()) == sorted(map(sorted, wanted))
    assert all(centre == rows[0][0] and own == rows[n - 4][0] for bucket in by_band.values() for own, centre, n in bucket)
