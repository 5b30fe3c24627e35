"""Joins and per-key choices with a key that holds a third of the rows, against brute force."""

from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from triplewright.operators import resolve, skew

N = 3000


@pytest.fixture
def hot(monkeypatch):
    """Thresholds at which the small frames below count as large."""
    monkeypatch.setattr(skew, "HOT_SHARE", 1 / 20)
    monkeypatch.setattr(skew, "HOT_MIN_ROWS", 10)


@pytest.fixture
def plain_shuffles(spark):
    """No run-time rescue: no broadcast by Catalyst, no merging of small partitions."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.enabled": "false",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def rows(df, *columns):
    return Counter(map(tuple, df.select(*columns).collect()))


def values(i):
    return f"v{i:04d}" + "x" * (i * 7 % 5)


FACTS = [("hot" if i % 3 == 0 else f"k{i % 500}", values(i)) for i in range(N)]


@pytest.fixture
def facts(spark):
    return spark.createDataFrame(FACTS, "sub string, obj string").repartition(8)


def test_hot_keys_are_found_and_bounded(spark, facts, hot):
    (found,) = skew.hot_keys([facts], "sub")
    (key,) = facts.select(F.xxhash64(F.lit("hot")).alias("h")).first()
    assert found.keys() == {key}
    assert 6 <= found[key] <= 8
    assert skew.hot_keys([facts, facts.filter("sub <> 'hot'")], "sub")[1] == {}


def test_keys_just_above_the_share_are_found(spark):
    share = 1 / 1000
    df = spark.range(400_000).select(F.when(F.col("id") % 2 == 0, F.col("id") % 800).otherwise(F.col("id")).alias("k"))
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(skew, "HOT_MIN_ROWS", 10)
        (found,) = skew.hot_keys([df], "k")
    assert skew.HOT_SHARE == share
    assert len(found) == 400


def pairs(left, right):
    by_key = defaultdict(list)
    for k, v in right:
        by_key[k].append(v)
    return Counter((k, v, w) for k, v in left for w in by_key[k])


@pytest.mark.parametrize("hot_side", ["left", "right", "both", "neither"])
def test_skew_join(spark, hot, plain_shuffles, hot_side):
    few = [(k, f"w{i}") for i, k in enumerate(["hot", "hot", "k1", "k2", "missing"])]
    many = FACTS[:900]
    other = [(k, f"w{v}") for k, v in FACTS[:300]]
    left, right = {"left": (many, few), "right": (few, many), "both": (many, other), "neither": (few, few)}[hot_side]
    a = spark.createDataFrame(left, "k string, v string")
    b = spark.createDataFrame(right, "k string, w string")
    joined = skew.skew_join(a, b, "k")
    assert joined.columns == ["k", "v", "w"]
    assert rows(joined, "k", "v", "w") == pairs(left, right)
    if hot_side != "neither":
        spread = joined.filter("k = 'hot'").groupBy(F.spark_partition_id()).count().count()
        assert spread >= 4


def test_skew_join_probe_only_steers(spark, hot, plain_shuffles):
    few = [("hot", "w"), ("k1", "u")]
    a, b = spark.createDataFrame(FACTS, "k string, v string"), spark.createDataFrame(few, "k string, w string")
    wrong = spark.createDataFrame([("k1", "")] * 100, "k string, v string")
    assert rows(skew.skew_join(a, b, "k", left_probe=wrong), "k", "v", "w") == pairs(FACTS, few)


@pytest.mark.parametrize("limit", [0, skew.BROADCAST_MAX_BYTES])
@pytest.mark.parametrize("how", ["left_semi", "left_anti"])
@pytest.mark.parametrize("listed", [["hot", "k1", "k1", "k2"], ["k1"]])
def test_existence_join(spark, facts, hot, plain_shuffles, monkeypatch, limit, how, listed):
    monkeypatch.setattr(skew, "BROADCAST_MAX_BYTES", limit)
    right = spark.createDataFrame([(k, "") for k in listed], "sub string, ignored string")
    keep = (lambda k: k in listed) if how == "left_semi" else (lambda k: k not in listed)
    got = skew.existence_join(facts, right, "sub", how)
    assert got.columns == ["sub", "obj"]
    assert rows(got, "sub", "obj") == Counter(r for r in FACTS if keep(r[0]))


def test_anti_join_keeps_null_keys(spark, plain_shuffles, monkeypatch):
    monkeypatch.setattr(skew, "BROADCAST_MAX_BYTES", 0)
    left = spark.createDataFrame([(None, "a"), ("k", "b")], "sub string, obj string")
    right = spark.createDataFrame([(None,), ("k",)], "sub string")
    assert rows(skew.existence_join(left, right, "sub", "left_anti"), "sub", "obj") == Counter([(None, "a")])


@pytest.mark.parametrize("limit", [0, skew.BROADCAST_MAX_BYTES])
def test_lookup_join(spark, facts, hot, plain_shuffles, monkeypatch, limit, capsys):
    monkeypatch.setattr(skew, "BROADCAST_MAX_BYTES", limit)
    lookup = [("hot", "A"), ("hot", "B"), ("k1", "C")]
    got = skew.lookup_join(facts, spark.createDataFrame(lookup, "sub string, new string"), "sub")
    assert rows(got, "sub", "obj", "new") == pairs(FACTS, lookup)
    got.explain()
    assert ("SortMergeJoin" in capsys.readouterr().out) == (limit == 0)


def by_key(data):
    groups = defaultdict(list)
    for k, v in data:
        groups[k].append(v)
    return groups


@pytest.fixture(params=[True, False], ids=["hot", "cold"])
def maybe_hot(request):
    if request.param:
        request.getfixturevalue("hot")


def with_copies(spark):
    data = FACTS + FACTS[:400] + [("copies", "same value")] * 600
    return data, spark.createDataFrame(data, "sub string, obj string").repartition(8)


def test_with_key_count(spark, maybe_hot):
    data, df = with_copies(spark)
    sizes = {k: len(v) for k, v in by_key(data).items()}
    assert rows(resolve.with_key_count(df, "sub"), "sub", "obj", "n") == Counter((k, v, sizes[k]) for k, v in data)


@pytest.mark.parametrize("limit", [0, skew.BROADCAST_MAX_BYTES])
def test_rank_longest(spark, maybe_hot, monkeypatch, limit):
    monkeypatch.setattr(skew, "BROADCAST_MAX_BYTES", limit)
    data, df = with_copies(spark)
    groups = by_key(data)
    wanted = Counter((k, v, len(v), 1 + sum(len(o) > len(v) for o in groups[k])) for k, v in data)
    assert rows(resolve.rank_longest(df, "sub", "obj"), "sub", "obj", "len", "rank") == wanted


def test_longest_per_key(spark, maybe_hot):
    data, df = with_copies(spark)
    wanted = {(k, v) for k, vs in by_key(data).items() for v in vs if len(v) == max(map(len, vs))}
    got = rows(resolve.longest_per_key(df, "sub", "obj"), "sub", "obj")
    assert got == Counter(wanted)
    assert len([1 for k, _ in got if k == "hot"]) > 1


def test_single_and_conflicting_values(spark):
    data, df = with_copies(spark)
    groups = by_key(data)
    single = {(k, v[0]) for k, v in groups.items() if len(set(v)) == 1}
    conflict = {(k, x) for k, v in groups.items() if len(set(v)) > 1 for x in v}
    assert ("copies", "same value") in single
    assert rows(resolve.single_value(df, "sub", "obj"), "sub", "obj") == Counter(single)
    assert rows(resolve.conflicting_values(df, "sub", "obj"), "sub", "obj") == Counter(conflict)


def test_prefer_on_conflict(spark):
    data = [("a", "x"), ("a", "x"), ("b", "x"), ("b", "P"), ("c", "x"), ("c", "y"), ("d", "P")]
    df = spark.createDataFrame(data, "sub string, obj string")
    got = rows(resolve.prefer_on_conflict(df, "sub", "obj", "P"), "sub", "obj")
    assert got == Counter([("a", "x"), ("b", "P"), ("d", "P")])


def test_count_distinct_values(spark, plain_shuffles, capsys):
    data, df = with_copies(spark)
    counted = resolve.count_distinct_values(df, "sub", "obj")
    assert rows(counted, "sub", "n") == Counter((k, len(set(v))) for k, v in by_key(data).items())
    counted.explain()
    assert "Exchange hashpartitioning(sub" in capsys.readouterr().out


@pytest.mark.parametrize("limit, hot_rows", [(skew.BROADCAST_MAX_BYTES, 10**6), (0, 10**6), (0, 2)])
def test_columns_do_not_depend_on_the_way(spark, monkeypatch, limit, hot_rows):
    """Key-last input, for broadcasts, shuffles, and hot keys."""
    monkeypatch.setattr(skew, "BROADCAST_MAX_BYTES", limit)
    monkeypatch.setattr(skew, "HOT_MIN_ROWS", hot_rows)
    df = spark.createDataFrame([(f"v{i}", "a" if i % 2 else f"k{i}") for i in range(40)], "obj string, sub string")
    keys = df.select("sub").limit(5)
    assert skew.existence_join(df, keys, "sub", "left_semi").columns == ["obj", "sub"]
    assert skew.existence_join(df, keys, "sub", "left_anti").columns == ["obj", "sub"]
    lookup = spark.createDataFrame([("a", 1)], "sub string, w int")
    assert skew.lookup_join(df, lookup, "sub").columns == ["sub", "obj", "w"]
    assert resolve.with_key_count(df, "sub").columns == ["obj", "sub", "n"]
    assert resolve.rank_longest(df, "sub", "obj").columns == ["obj", "sub", "len", "rank"]
    assert resolve.longest_per_key(df, "sub", "obj").columns == ["obj", "sub"]


def test_copied_facts_are_spread_over_slices(spark, monkeypatch):
    """A fact copied a thousand times, joined with a lookup beyond the broadcast limit."""
    monkeypatch.setattr(skew, "BROADCAST_MAX_BYTES", 0)
    monkeypatch.setattr(skew, "HOT_MIN_ROWS", 50)
    facts = spark.createDataFrame([("s", "g")] * 1000 + [(f"s{i}", "g") for i in range(200)], "sub string, g string")
    lookup = spark.createDataFrame([("g", "new")], "g string, new string")
    joined = skew.lookup_join(facts, lookup, "g", distinct=True)
    assert rows(joined, "sub") == Counter([("s",), *((f"s{i}",) for i in range(200))])


@pytest.mark.parametrize("distinct", [[], ["left"], ["right"], ["left", "right"]])
def test_skew_join_drops_copies_of_the_sides_named(spark, maybe_hot, plain_shuffles, distinct):
    left, right = FACTS[:300] * 2 + [(None, "n")] * 2, [("hot", "w"), ("hot", "w"), ("k1", None), ("k1", None), (None, "n")]
    a, b = spark.createDataFrame(left, "k string, v string"), spark.createDataFrame(right, "k string, w string")
    wanted = pairs(set(left) if "left" in distinct else left, set(right) if "right" in distinct else right)
    got = rows(skew.skew_join(a, b, "k", distinct=distinct), "k", "v", "w")
    assert got == Counter({row: n for row, n in wanted.items() if row[0] is not None})


def test_copies_are_dropped_on_the_partitioning_of_the_join(spark, plain_shuffles, capsys):
    a, b = spark.createDataFrame(FACTS, "k string, v string"), spark.createDataFrame(FACTS, "k string, w string")
    skew.skew_join(a, b, "k", distinct=["left", "right"]).explain()
    assert capsys.readouterr().out.count("Exchange") == 2


def test_keys_without_large_cells_are_not_sketched(spark, facts, hot, monkeypatch):
    sketched = []
    real = skew.sketch_keys
    monkeypatch.setattr(skew, "sketch_keys", lambda hashed, by: sketched.append(hashed.count()) or real(hashed, by))
    cold = spark.range(1000).select(F.col("id").cast("string").alias("sub"))
    assert skew.hot_keys([cold], "sub") == [{}] and not sketched
    (found,) = skew.hot_keys([facts], "sub")
    assert found and sum(1 for k, _ in FACTS if k == "hot") <= sketched[0] < N


def test_rows_are_derived_once_for_the_search_and_the_join(spark):
    derived = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def seen(key):
        derived.add(1)
        return key

    df = spark.createDataFrame(FACTS, "k string, v string").select(seen("k").alias("k"), "v")
    written, probe = skew.scanned_once(df, df, "rows")
    assert skew.skew_join(written, spark.createDataFrame([("k1", "w")], "k string, w string"), "k", left_probe=probe).count()
    assert derived.value == N
    sketch = skew.KeySketch(df)
    assert skew.scanned_once(df, sketch, "rows") == (df, sketch)
