"""What is stored with triples and spares later work: sketches, filters, layouts by subject, digests."""

import hashlib
import random
from collections import Counter
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tests.compare import database, differences
from triplewright.operators import bloom, resolve, skew
from triplewright.operators.stored import KEYS, probe, sketch_predicates
from triplewright.plans import changes, company, extract, person, pipeline
from triplewright.sources import triples, versions
from triplewright.sources.clustered import cluster_by_subject, with_clusters
from triplewright.sources.mappings import read_code_mapping, read_country_mapping
from triplewright_checks.fixtures import Fixtures
from triplewright_checks.oracle import ORACLE

SF_DIR = "/root/testdata/sf0.001"
NAMES = ["organization", "quote", "industry", "person"]


def rows(df, *columns):
    return Counter(map(tuple, df.select(*(columns or df.columns)).collect()))


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    target, fx = str(tmp_path_factory.mktemp("stored")), Fixtures(spark, SF_DIR)
    dumps = {name: fx.write_lines(getattr(fx, name)(), name) for name in NAMES}
    triples.ingest_triples(spark, dumps, target)
    return target, {name: triples.open_triples(spark, f"{target}/{name}") for name in NAMES}


@pytest.fixture
def hot(monkeypatch):
    monkeypatch.setattr(skew, "HOT_SHARE", 1 / 150)
    monkeypatch.setattr(skew, "HOT_MIN_ROWS", 5)


# Sketches


@pytest.mark.parametrize("dump, preds, key", [
    ("organization", [company.PRIMARY_QUOTE], "id"),
    ("organization", [company.DOMICILE, company.INCORPORATION], "value"),
    ("organization", company.SECTORS, "id"),
    ("organization", [company.NAME], "sub"),
    ("person", [company.HOLDER], "id"),
    ("person", company.POSITIONS, "sub"),
    ("person", ["family-name"], "value"),
    ("quote", [company.EXCHANGE_CODE], "value"),
])
def test_stored_sketches_find_the_same_hot_keys(stored, hot, dump, preds, key):
    kept = stored[1][dump]
    (from_sketch,) = skew.hot_keys([probe(kept, preds, key)], "sub")
    (from_rows,) = skew.hot_keys([probe(kept.rows, preds, key)], "sub")
    assert from_sketch == from_rows
    assert from_rows or key == "sub" or preds == [company.HOLDER] or preds == [company.PRIMARY_QUOTE]


def test_sketches_and_frames_are_probed_together(spark, stored, hot):
    kept = stored[1]["organization"]
    frame = probe(kept.rows, company.SECTORS, "id", "ind")
    found = skew.hot_keys([frame, probe(kept, company.SECTORS, "id"), frame.limit(0)], "ind")
    assert found[0] == found[1] and found[0] and not found[2]


def test_few_rows_need_no_look_at_sketches(spark, stored, monkeypatch):
    kept = stored[1]["quote"]
    unread = replace(kept, keys=kept.keys.filter("raise_error('read') IS NULL"))
    assert skew.hot_keys([probe(unread, [company.TICKER], "sub")] * 2, "sub") == [{}, {}]
    monkeypatch.setattr(skew, "HOT_MIN_ROWS", 1)
    with pytest.raises(Exception, match="read"):
        skew.hot_keys([probe(unread, [company.TICKER], "sub")], "sub")


def test_sketches_are_mergeable_over_dumps(spark, hot):
    data = [(f"s{i % 7}", f"p{i % 3}", f"<http://h/{i % 11}>" if i % 2 else '"x"') for i in range(900)]
    df = spark.createDataFrame(data, "sub string, pred string, obj string")
    parts = [sketch_predicates(df.filter(F.crc32("obj") % 2 == i)) for i in range(2)]
    whole = skew.hot_keys([skew.KeySketch(sketch_predicates(df).filter("key = 'id'").select("n", "sketch"))], "x")
    both = parts[0].union(parts[1]).filter("key = 'id'").select("n", "sketch")
    assert skew.hot_keys([skew.KeySketch(both)], "x") == whole and whole[0]
    sizes = sketch_predicates(df).filter("key = 'sub'").agg(F.sum("n"), F.sum("bytes")).first()
    assert tuple(sizes) == (900, sum(len(s) + len(o) for s, _, o in data))
    assert set(KEYS) == {"sub", "id", "value"}


def test_parts_of_stored_triples_keep_their_large_keys(spark, stored, monkeypatch):
    """Of a part, a key counts as hot by its own size, as its share is unknown."""
    kept = stored[1]["organization"]
    monkeypatch.setattr(skew, "HOT_MIN_ROWS", 20)
    monkeypatch.setattr(skew, "HOT_SHARE", 1 / 5)
    part = kept.restricted_to(kept.rows.filter("sub < '1-2'"))
    assert skew.hot_keys([probe(kept, company.SECTORS, "id")], "sub")[0].keys() < skew.hot_keys(
        [probe(part, company.SECTORS, "id")], "sub"
    )[0].keys()


@pytest.mark.parametrize("ways", ["plain", "hot"])
def test_attribute_tables_over_stored_triples(spark, stored, request, monkeypatch, ways):
    if ways == "hot":
        request.getfixturevalue("hot")
        monkeypatch.setattr(skew, "BROADCAST_MAX_BYTES", 0)
    connection, fx = database(SF_DIR), Fixtures(spark, SF_DIR)
    organization, quote, industry, people = (stored[1][name] for name in NAMES)
    family, given = person.person_family_name(people, fx.blocklist()), person.person_given_name(people)
    tables = {
        "company_exchange": company.company_exchange(organization, quote, fx.exchange_map()),
        "company_name": company.company_name(organization),
        "company_address": company.company_address(organization),
        "company_url": company.company_url(organization),
        "company_country_all": company.company_country_all(organization, fx.geo_map()),
        "company_industry": company.company_industry(organization, industry, fx.industry_map()),
        "company_employee": company.company_employee(people, family, given),
        "listed_company_graph": extract.listed_company_graph(
            organization, quote, people, family, given, fx.exchange_map(), fx.geo_map()
        ),
    }
    for name, table in tables.items():
        assert differences(table, connection, ORACLE[name]) == [], name


def test_joins_on_stored_triples_probe_no_rows(spark, stored, monkeypatch):
    """Hot keys of stored rows come from sketches alone; frames are probed only for what joins produce."""
    probed = []
    real = skew.hot_keys

    def spying(frames, on):
        probed.extend(f for f in frames if not isinstance(f, skew.KeySketch))
        return real(frames, on)

    monkeypatch.setattr(skew, "hot_keys", spying)
    monkeypatch.setattr(resolve, "hot_keys", spying)
    organization, quote, _, people = (stored[1][name] for name in NAMES)
    fx = Fixtures(spark, SF_DIR)
    company.company_address(organization)
    company.company_url(organization)
    assert probed == []
    company.company_exchange(organization, quote, fx.exchange_map())
    company.company_employee(people, person.person_family_name(people), person.person_given_name(people))
    # The written products of codes and tickers, positions and names.
    assert len(probed) == 3
    assert all("/triples" not in f for frame in probed for f in frame.inputFiles())
    assert all(stored[0] not in f for frame in probed for f in frame.inputFiles())


# Bloom filters


def test_filter_has_no_false_negatives_and_few_false_positives(spark):
    keys = spark.range(0, 40_000, 2).select(F.concat(F.lit("k"), "id").alias("k"))
    df = spark.range(40_000).select(F.concat(F.lit("k"), "id").alias("k"), "id")
    blocks = bloom.n_blocks(20_000)
    possible, unlisted = bloom.split_by_filter(df, ["k"], bloom.bloom_filter(keys, ["k"], blocks), blocks)
    assert possible.columns == unlisted.columns == ["k", "id"]
    assert possible.filter("id % 2 = 0").count() == 20_000
    assert possible.filter("id % 2 = 1").count() < 400
    assert possible.count() + unlisted.count() == 40_000


def test_filters_have_a_fixed_size():
    assert bloom.n_blocks(0) == bloom.n_blocks(1) == 1
    assert bloom.n_blocks(10**6) * 512 >= 10**6 * bloom.BITS_PER_KEY
    assert bloom.n_blocks(80 * 10**6) == bloom.MAX_BLOCKS
    assert bloom.n_blocks(10**9) is None


@pytest.mark.parametrize("way", ["filter", "full filter", "no filter"])
@pytest.mark.parametrize("how", ["left_semi", "left_anti"])
@pytest.mark.parametrize("with_hot", [True, False])
def test_existence_joins_are_the_same_on_every_way(spark, monkeypatch, way, how, with_hot):
    if with_hot:
        monkeypatch.setattr(skew, "HOT_SHARE", 1 / 20)
        monkeypatch.setattr(skew, "HOT_MIN_ROWS", 10)
    monkeypatch.setattr(bloom, "MAX_BLOCKS", {"filter": 1 << 19, "full filter": 1, "no filter": 0}[way])
    data = [("hot" if i % 3 == 0 else f"k{i % 400}", f"v{i}") for i in range(3000)] + [(None, "n"), (None, "n")]
    left = spark.createDataFrame(data, "k string, v string").repartition(4)
    listed = ["hot", *(f"k{i}" for i in range(0, 400, 7))]
    right = spark.createDataFrame([(k,) for k in [*listed, *listed, None]], "k string")
    got = skew.existence_join(left, right, "k", how, limit=0)
    assert got.columns == ["k", "v"]
    assert rows(got) == Counter(row for row in data if (row[0] in listed) == (how == "left_semi"))


def shuffled_rows(df):
    """Rows that each exchange by ``k`` of an executed plan has written."""
    found = []

    def walk(node):
        if node.nodeName() == "Exchange" and "hashpartitioning(k" in node.simpleString(100):
            found.append(node.metrics().apply("shuffleRecordsWritten").value())
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))

    walk(df._jdf.queryExecution().executedPlan())
    return found


@pytest.mark.parametrize("how, n", [("left_semi", 100), ("left_anti", 49_900)])
def test_only_rows_that_pass_the_filter_are_shuffled(spark, how, n):
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        df = spark.range(0, 50_000, 1, 4).select(F.concat(F.lit("k"), "id").alias("k"))
        keys = spark.range(100).select(F.concat(F.lit("k"), "id").alias("k"))
        joined = skew.existence_join(df, keys, "k", how, balanced=True, limit=0)
        assert len(joined.collect()) == n
        written = shuffled_rows(joined)
        assert written and sum(written) < 1000 + 2 * 4 * 100  # the keys, once or twice, and what passes
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


# Layout by subject


@pytest.fixture
def plain_plans(spark):
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.enabled", before)


BY_SUBJECT = {
    "company_name": (company.company_name, company.NAME),
    "company_address": (company.company_address, company.ADDRESS),
    "company_url": (company.company_url, company.URL),
}


@pytest.mark.parametrize("with_hot", [True, False])
def test_layout_by_subject_needs_no_shuffle(spark, stored, monkeypatch, plain_plans, with_hot):
    if with_hot:
        monkeypatch.setattr(skew, "HOT_SHARE", 1 / 150)
        monkeypatch.setattr(skew, "HOT_MIN_ROWS", 2)
    monkeypatch.setattr("triplewright.sources.clustered.BUCKET_BYTES", 100_000)
    database_name = f"by_subject_{with_hot}".lower()
    spark.sql(f"CREATE DATABASE {database_name}")
    target, kept = stored[0], stored[1]["organization"]
    preds = [pred for _, pred in BY_SUBJECT.values()]
    root = f"{target}/organization"
    cluster_by_subject(spark, kept, preds, database_name, root)
    laid_out = cluster_by_subject(spark, kept, preds, database_name, root)  # repeated
    connection = database(SF_DIR)
    for name, (derive, pred) in BY_SUBJECT.items():
        by_subject, hot_rows = laid_out.clustered[pred]
        assert (hot_rows is not None) == with_hot or name == "company_url"
        table = derive(laid_out)
        assert differences(table, connection, ORACLE[name]) == [], name
        if hot_rows is None:
            assert "Exchange" not in table._jdf.queryExecution().executedPlan().toString()
        else:
            assert hot_rows.join(by_subject, "sub").isEmpty()
            # Only what is left of a few hot subjects after partial aggregation is exchanged.
            cold_part = derive(replace(laid_out, clustered={pred: (by_subject, None)}))
            assert "Exchange" not in cold_part._jdf.queryExecution().executedPlan().toString()
    assert with_clusters(spark, kept, ["no such"], database_name, root).clustered == {}


# A number of companies


@pytest.mark.parametrize("n", [0, 1, 7, 499, 500, 501, 9000])
def test_exactly_n_rows_are_taken(spark, monkeypatch, n):
    monkeypatch.setattr(resolve, "CUT_DIGITS", 1)
    monkeypatch.setattr(resolve, "CUT_ROWS", 5)
    keys = [f"1-{i}" for i in range(500)]
    df = spark.createDataFrame([(k, 1) for k in keys], "sub string, x int").repartition(3)
    got = resolve.smallest_by_hash(df, "sub", n)
    assert got.columns == ["sub", "x"]
    wanted = sorted(keys, key=lambda k: hashlib.md5(k.encode()).hexdigest())[:n]
    assert sorted(row["sub"] for row in got.collect()) == sorted(wanted)


# Changes


def test_changed_subjects(spark):
    old = [("a", "p", "1"), ("a", "p", "2"), ("b", "p", "1"), ("c", "p", "1"), ("d", "p", "1"), ("d", "p", "1")]
    new = [("a", "p", "2"), ("a", "p", "1"), ("b", "p", "9"), ("d", "p", "1"), ("e", "p", "1")]
    digests = [triples.subject_digests(spark.createDataFrame(x, "sub string, pred string, obj string")) for x in (old, new)]
    assert rows(changes.changed_subjects(*digests)) == Counter([("b",), ("c",), ("d",), ("e",)])


@pytest.fixture(scope="module")
def job(spark, tmp_path_factory):
    root, fx = tmp_path_factory.mktemp("changes"), Fixtures(spark, SF_DIR)
    for name, mapping in (("exchange_map", fx.exchange_map()), ("industry_map", fx.industry_map()), ("country_map", fx.geo_map())):
        spark.read.text(fx.write_mapping(mapping)).write.text(f"{root}/mappings/{name}")
    lines = {name: [row["value"] for row in spark.read.text(fx.write_lines(getattr(fx, name)())).collect()] for name in NAMES}
    paths = pipeline.JobPaths(f"{root}/dumps", f"{root}/mappings", f"{root}/triples", f"{root}/rejects", "ch_company_", "ch_person_")
    return root, paths, lines, pipeline.Choices(family_exclusions=fx.blocklist())


def write_dumps(spark, root, lines):
    for name, own in lines.items():
        spark.createDataFrame([(x,) for x in own], "value string").repartition(2).write.mode("overwrite").text(f"{root}/dumps/{name}")


def altered(lines, seed):
    """Some triples less, some others, some of other subjects."""
    draw = random.Random(seed)
    found = {}
    for name, own in lines.items():
        kept = []
        for line in own:
            x = draw.random()
            if x < 0.02:
                continue
            kept.append(line if x > 0.04 else line.replace("1-3", "1-4", 1) if x > 0.03 else line.replace('"', '"Z', 1))
        found[name] = kept
    return found


def test_changes_give_what_a_whole_run_gives(spark, job):
    root, paths, lines, choices = job
    write_dumps(spark, root, altered(lines, 1))
    pipeline.ingest(spark, paths, NAMES)
    first = pipeline.derive(spark, paths, f"{root}/tables", choices, changes_only=True)
    assert len(first) == 10  # nothing was derived before
    assert pipeline.derive(spark, paths, f"{root}/tables", choices, changes_only=True) == []
    for seed in (2, None):  # None: back to the whole dumps
        write_dumps(spark, root, altered(lines, seed) if seed else lines)
        pipeline.ingest(spark, paths, NAMES)
        updated = pipeline.derive(spark, paths, f"{root}/tables", choices, changes_only=True)
        assert updated == first
        whole = replace(paths, company="w_company_", person="w_person_")
        for table, other in zip(updated, pipeline.derive(spark, whole, f"{root}/whole", choices)):
            a, b = spark.read.table(table), spark.read.table(other)
            columns = sorted(a.columns)
            assert rows(a, *columns) == rows(b, *columns), table


def test_only_dependent_tables_follow_a_dump(spark, job):
    root, paths, lines, choices = job
    write_dumps(spark, root, lines)
    pipeline.ingest(spark, paths, NAMES)
    pipeline.derive(spark, paths, f"{root}/tables", choices)
    pipeline.ingest(spark, paths, ["quote"])
    assert pipeline.derive(spark, paths, f"{root}/tables", choices, changes_only=True) == ["ch_company_exchange"]
    other = replace(choices, preferred_industry="Retail")
    assert len(pipeline.derive(spark, paths, f"{root}/tables", other, changes_only=True)) == 10
    assert read_code_mapping(spark, f"{paths.mappings}/exchange_map").count() > 0
    assert read_country_mapping(spark, f"{paths.mappings}/country_map").count() == 25
    assert len(versions.published(spark, f"{paths.triples}/quote")) == versions.KEPT_VERSIONS
