"""Reading dumps and lookup files, ingest, and writing results."""

import itertools
import re
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from triplewright import session
from triplewright.functions import text
from triplewright.plans.etl import run_employee_report
from triplewright.plans.stats import predicate_stats, predicate_stats_by_dump, stored_predicate_stats
from triplewright.sources import mappings, sinks, triples, versions
from triplewright_checks import fixtures
from triplewright_checks.queries import QUERIES

LINES = {
    '<a/b> <c#d> "x" .': ("b", "d", '"x"'),
    '<http://h/1-2> <http://h/ns#name> "two words  and gaps"@en .': ("1-2", "name", '"two words  and gaps"@en'),
    "<http://h/1> <http://h/p> <http://h/2>": ("1", "p", ""),
    "<http://h/1> <http://h/p> no final dot": ("1", "p", "no final"),
    "<http://h/1> <http://h/p>": ("1", "p", ""),
    "_:b1 <http://h/p> x .": (":b", "p", "x"),
    "a  b .": ("", "", "b"),
    "<s> <p> <o> . ": ("s", "p", "<o> ."),
}
REJECTED = ["", "single", "<http://h/1>"]


@pytest.fixture
def dump(tmp_path):
    path = tmp_path / "dump.nt"
    path.write_text("\n".join([*LINES, *REJECTED]) + "\n")
    return str(path)


def rows(df, *columns):
    return Counter(map(tuple, df.select(*columns).collect()))


def test_parse_triples(spark, dump):
    lines = triples.read_lines(spark, dump)
    assert rows(triples.parse_triples(lines), "sub", "pred", "obj") == Counter(LINES.values())
    assert rows(triples.rejected_lines(lines), "value") == Counter((line,) for line in REJECTED)


def test_parse_agrees_with_splitting_at_single_spaces(spark):
    texts = ["x", " ", "<a/b>", "c#d>", '"v w"', ".", "", "é ü"]
    lines = [f"{a} {b} {c} {d}" for a in texts for b in texts for c in texts for d in texts]

    def expected(line):
        subject, _, rest = line.partition(" ")
        predicate, _, rest = rest.partition(" ")
        names = [re.search(end, token[1:][:-1]).group() for end, token in (("[^/]*$", subject), ("[^/#]*$", predicate))]
        return (*names, rest.rpartition(" ")[0])

    df = spark.createDataFrame([(line,) for line in lines], "value string")
    assert rows(triples.parse_triples(df), "sub", "pred", "obj") == Counter(map(expected, lines))


def test_ingest_stores_triples_and_rejects(spark, dump, tmp_path):
    target, rejects = str(tmp_path / "triples"), str(tmp_path / "rejects")
    for _ in range(2):
        counts = triples.ingest_triples(spark, {"organization": dump}, target, rejects)
        stored = triples.read_triples(spark, f"{target}/organization")
        assert counts == {"organization": {"lines": len(LINES) + len(REJECTED), "rejected": len(REJECTED)}}
        assert stored.columns == ["sub", "pred", "obj"]
        assert rows(stored, "sub", "pred", "obj") == Counter(LINES.values())
        assert rows(spark.read.text(f"{rejects}/organization"), "value") == Counter((x,) for x in REJECTED)


def test_repaired_dump_has_no_rejects(spark, tmp_path):
    path, target, rejects = tmp_path / "dump.nt", str(tmp_path / "t"), str(tmp_path / "r")
    for line, n in (("bad", 1), ("<a/b> <c#1> x .", 0)):
        path.write_text(f"{line}\n<a/b> <c#2> y .\n")
        triples.ingest_triples(spark, {"quote": str(path)}, target, rejects)
        assert spark.read.text(f"{rejects}/quote").count() == n
        assert triples.read_triples(spark, f"{target}/quote").count() == 2 - n


def test_ingest_into_catalog_tables(spark, dump, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS kg")
    triples.ingest_triples(spark, {"organization": dump}, str(tmp_path / "t"), database="kg")
    assert spark.read.table("kg.organization").count() == len(LINES)
    named = spark.sql("SELECT sub, obj FROM kg.organization WHERE pred = 'name'")
    assert rows(named, "sub", "obj") == Counter([("1-2", '"two words  and gaps"@en')])


def test_ingest_without_rejects_writes_none(spark, tmp_path):
    path = tmp_path / "clean.nt"
    path.write_text("<a/b> <c#1> x .\n")
    triples.ingest_triples(spark, {"quote": str(path)}, str(tmp_path / "t"), str(tmp_path / "r"))
    assert spark.read.text(str(tmp_path / "r/quote")).isEmpty()
    assert rows(triples.read_triples(spark, str(tmp_path / "t/quote")), "pred") == Counter([("1",)])


def test_large_predicate_is_cut_into_several_files(spark, tmp_path):
    source, target = str(tmp_path / "dump"), tmp_path / "triples"
    row = F.col("id")
    pred = F.when(row % 3 == 0, F.concat(F.lit("p"), row % 5)).otherwise("large")
    text = F.concat(F.lit("<s/"), row, F.lit("> <"), pred, F.lit('> "'), F.sha2(row.cast("string"), 256), F.lit('" .'))
    spark.range(0, 60_000, 1, 8).select(text).write.text(source)
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256KB")
    try:
        triples.ingest_triples(spark, {"quote": source}, str(target))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = {p.name: len(list(p.glob("*.parquet"))) for p in (target / "quote").glob("data/*/lines/kind=triple/pred=*")}
    assert len(files) == 6
    assert files["pred=large"] >= 4
    assert triples.read_triples(spark, f"{target}/quote").count() == 60_000


def _stored_files(spark, target, preds_per_task):
    """Files of each partition of a dump of eight files, with one large predicate, some rare ones and rejected lines."""
    row = F.col("id")
    pred = F.when(row % 10 == 0, F.concat(F.lit("p"), (row / 10).cast("int") % preds_per_task)).otherwise("large")
    text = F.concat(F.lit("<s/"), row, F.lit("> <"), pred, F.lit('> "'), F.sha2(row.cast("string"), 256), F.lit('" .'))
    lines = spark.range(0, 16_000, 1, 8).select(F.when(row % 4000 == 3999, "bad").otherwise(text).alias("value"))
    lines.write.text(f"{target}/dump")
    counts = triples.ingest_triples(spark, {"quote": f"{target}/dump"}, str(target))
    assert counts == {"quote": {"lines": 16_000, "rejected": 4}}
    assert triples.read_rejects(spark, f"{target}/quote").count() == 4
    stored = triples.read_triples(spark, f"{target}/quote")
    assert stored.count() == 15_996 and stored.filter("pred = 'large'").distinct().count() == 14_396
    tasks = triples.read_lines(spark, f"{target}/dump").select(F.spark_partition_id().alias("t")).distinct().count()
    return tasks, {p.name: len(list(p.glob("*.parquet"))) for p in target.glob("quote/data/*/lines/kind=*/pred=*")}


def test_large_predicates_are_stored_by_the_tasks_that_read_them(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(triples, "FILE_BYTES", 50_000)
    tasks, files = _stored_files(spark, tmp_path, 20)
    assert tasks > 1 and files.pop("pred=large") == tasks
    assert len(files) == 21 and set(files.values()) == {1}


def test_a_dump_of_few_predicates_is_stored_without_a_shuffle(spark, tmp_path):
    tasks, files = _stored_files(spark, tmp_path, 2)
    assert files["pred=large"] == files["pred=p1"] == tasks > 1


def test_an_empty_dump_is_stored(spark, tmp_path):
    (tmp_path / "dump.nt").write_text("")
    counts = triples.ingest_triples(spark, {"quote": str(tmp_path / "dump.nt")}, str(tmp_path / "t"))
    assert counts == {"quote": {"lines": 0, "rejected": 0}}
    assert triples.read_triples(spark, str(tmp_path / "t/quote")).count() == 0


def test_scratch_path_needs_a_shared_folder_on_a_cluster():
    class Session:
        class conf:
            get = staticmethod(lambda key, default="warehouse": default)

        class sparkContext:
            master = "spark://cluster"

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.scratch_path(Session, "x")
    Session.sparkContext.master = "local[2]"
    assert session.scratch_path(Session, "x") != session.scratch_path(Session, "x")


def test_predicate_filter_prunes_partitions(spark, dump, tmp_path, capsys):
    triples.ingest_triples(spark, {"organization": dump}, str(tmp_path))
    stored = triples.read_triples(spark, f"{tmp_path}/organization").filter("pred = 'name'").select("sub")
    stored.explain("formatted")
    plan = capsys.readouterr().out
    assert "PartitionFilters: [(coalesce(pred" in plan
    assert "ReadSchema: struct<sub:string>" in plan


def test_mappings_keep_empty_fields(spark, tmp_path):
    path = tmp_path / "map.tsv"
    path.write_text("<g1>\tFrance\tFR\n<g2>\tNowhere\t\n<g3>\n")
    got = mappings.read_country_mapping(spark, str(path))
    assert rows(got, "g", "origin", "new") == Counter(
        [("<g1>", "France", "FR"), ("<g2>", "Nowhere", ""), ("<g3>", None, None)]
    )


STAT_LINES = [
    '<https://kg.example/1> <http://h/p> "v" .',
    '<https://kg.example/2> <http://h/p> "v" .',
    "<https://kg.example/2> <> <o> .",
    "<https://other.example/1> <http://h/p> <o> .",
    '<https://kg.example/1> <http://h/p> "v".',
    "<https://kg.example/1> <http://h/q> <https://kg.example/2> .",
    '<https://kg.example/1> <http://h/p> "<https://kg.example/9> <http://h/inner> x ." .',
]


def test_predicate_stats(spark, tmp_path):
    path = tmp_path / "a.nt"
    path.write_text("\n".join(STAT_LINES) + "\n")
    stats = predicate_stats(spark, "https://kg.example/", str(path))
    expected = {("http://h/p", 2), ("", 1), ("http://h/q", 1), ("http://h/inner", 1)}
    assert set(map(tuple, stats.select("pred", "n").collect())) == expected

    by_dump = predicate_stats_by_dump(spark, "https://kg.example/", {"a": str(path), "b": str(path)})
    assert rows(by_dump, "source", "pred", "n") == Counter((s, p, n) for s in "ab" for p, n in expected)

    sinks.write_predicate_reports(by_dump, str(tmp_path / "reports"))
    assert {p.name for p in (tmp_path / "reports").glob("source=*")} == {"source=a", "source=b"}
    sinks.write_predicate_report(stats, str(tmp_path / "report"))
    lines = [x for p in Path(tmp_path / "report").glob("*.csv") for x in p.read_text().splitlines()]
    assert "Predicate\t# triple" in lines
    assert {x for x in lines if not x.startswith("Predicate")} == {f"{p}\t{n}" for p, n in expected}


def test_append_matches_columns_by_name(spark, tmp_path):
    df = spark.createDataFrame([("s", "p", "o")], "sub string, pred string, obj string")
    sinks.append_table(df, "append_by_name", str(tmp_path / "t"))
    sinks.append_table(df.select("obj", "sub", "pred"), "append_by_name", str(tmp_path / "t"))
    assert rows(spark.read.table("append_by_name"), "sub", "pred", "obj") == Counter({("s", "p", "o"): 2})
    with pytest.raises(ValueError, match="columns"):
        sinks.append_table(df.drop("obj"), "append_by_name")


@pytest.mark.parametrize("value", ["2026-12-01", "it's", "a\\b=c/d", "ü %"])
def test_a_repeated_run_replaces_its_own_rows_only(spark, tmp_path, value):
    table = f"runs_{abs(hash(value))}"
    df = spark.createDataFrame([("s", "p", "o"), ("s", "p", "o")], "sub string, pred string, obj string")
    for run, rows_ in (("before", df), (value, df), (value, df.limit(1)), (value, df)):
        sinks.append_table(rows_, table, str(tmp_path / "t"), run)
    assert rows(spark.read.table(table), "run") == Counter({("before",): 2, (value,): 2})
    sinks.append_table(df.limit(0), table, str(tmp_path / "t"), value)
    assert rows(spark.read.table(table), "run") == Counter({("before",): 2})


def test_runs_need_a_table_that_is_partitioned_by_them(spark, tmp_path):
    df = spark.createDataFrame([("s", "p", "o", "x")], "sub string, pred string, obj string, run string")
    sinks.save_table(df, "not_by_run", str(tmp_path / "t"))
    with pytest.raises(ValueError, match="not partitioned"):
        sinks.append_table(df.drop("run"), "not_by_run", run="x")


class Killed(Exception):
    pass


def killed_at(monkeypatch, module, name, call=1):
    """The ``call``-th call of a function ends the run instead."""
    real, calls = getattr(module, name), []

    def step(*args, **kwargs):
        calls.append(name)
        if len(calls) == call:
            raise Killed(name)
        return real(*args, **kwargs)

    monkeypatch.setattr(module, name, step)


# Each step of an ingest after which it may end.
STEPS = [
    (triples, "_sorted_out"),
    (triples, "sketch_predicates"),
    (triples, "subject_digests"),
    (versions, "publish"),
    (versions, "_create"),
]


@pytest.mark.parametrize("module, name", STEPS, ids=[name for _, name in STEPS])
def test_an_ingest_that_ends_early_leaves_the_old_version(spark, tmp_path, monkeypatch, module, name):
    dump, target = tmp_path / "dump.nt", str(tmp_path / "t")
    dump.write_text("<a/b> <c#old> x .\nbad\n")
    triples.ingest_triples(spark, {"quote": str(dump)}, target, str(tmp_path / "r"))
    dump.write_text("<a/b> <c#new> x .\nworse\n")
    with monkeypatch.context() as patch:
        killed_at(patch, module, name)
        with pytest.raises(Killed):
            triples.ingest_triples(spark, {"quote": str(dump)}, target, str(tmp_path / "r"))
    assert rows(triples.read_triples(spark, f"{target}/quote"), "pred") == Counter([("old",)])
    assert rows(triples.read_rejects(spark, f"{target}/quote"), "value") == Counter([("bad",)])
    triples.ingest_triples(spark, {"quote": str(dump)}, target, str(tmp_path / "r"))
    assert rows(triples.read_triples(spark, f"{target}/quote"), "pred") == Counter([("new",)])
    assert rows(spark.read.text(str(tmp_path / "r/quote")), "value") == Counter([("worse",)])


@pytest.mark.parametrize("module, name", [(triples, "_register"), (triples, "read_rejects"), (versions, "drop_old")])
def test_an_ingest_that_ends_after_publishing_has_the_new_version(spark, tmp_path, monkeypatch, module, name):
    dump, target = tmp_path / "dump.nt", str(tmp_path / "t")
    spark.sql("CREATE DATABASE IF NOT EXISTS kg_late")
    for text in ("old", "new"):
        dump.write_text(f"<a/b> <c#{text}> x .\n")
        with monkeypatch.context() as patch:
            if text == "new":
                killed_at(patch, module, name)
            try:
                triples.ingest_triples(spark, {"quote": str(dump)}, target, str(tmp_path / "r"), "kg_late")
            except Killed:
                pass
    assert rows(triples.read_triples(spark, f"{target}/quote"), "pred") == Counter([("new",)])
    assert rows(spark.read.table("kg_late.quote"), "pred") == Counter([("old" if name == "_register" else "new",)])
    triples.ingest_triples(spark, {"quote": str(dump)}, target, str(tmp_path / "r"), "kg_late")
    assert rows(spark.read.table("kg_late.quote"), "pred") == Counter([("new",)])


def test_rejects_never_appear_as_triples_whatever_predicates_are_called(spark, tmp_path):
    dump, target = tmp_path / "dump.nt", str(tmp_path / "t")
    dump.write_text("<a/b> <c#__rejected__> x .\n<a/b> <c#reject> y .\nbad\n<a/b> <c#triple> z .\n")
    triples.ingest_triples(spark, {"quote": str(dump)}, target)
    found = rows(triples.read_triples(spark, f"{target}/quote"), "pred", "obj")
    assert found == Counter([("__rejected__", "x"), ("reject", "y"), ("triple", "z")])


def test_nothing_published_is_no_empty_table(spark, tmp_path):
    (tmp_path / "t/data/unfinished").mkdir(parents=True)
    with pytest.raises(FileNotFoundError):
        triples.read_triples(spark, str(tmp_path / "t"))


def test_a_dump_of_rejects_only_has_no_triples(spark, tmp_path):
    dump = tmp_path / "dump.nt"
    dump.write_text("bad\n")
    triples.ingest_triples(spark, {"quote": str(dump)}, str(tmp_path / "t"))
    assert triples.read_triples(spark, str(tmp_path / "t/quote")).columns == ["sub", "pred", "obj"]
    assert triples.read_triples(spark, str(tmp_path / "t/quote")).isEmpty()


def test_versions(spark, tmp_path):
    root = str(tmp_path / "v")
    assert versions.current(spark, root) is None and not versions.is_versioned(spark, root)
    staged = []
    for n in range(1, 5):
        staged.append(versions.stage(root))
        Path(staged[-1]).mkdir(parents=True)
        assert versions.publish(spark, root, staged[-1], after=n - 1) == (n, staged[-1])
    with pytest.raises(versions.Outdated):
        versions.publish(spark, root, versions.stage(root), after=3)
    (tmp_path / "v/published/000000000005").touch()  # a run that ended while it wrote its pointer
    assert versions.current(spark, root) == (4, staged[3])
    left = Path(versions.stage(root))
    left.mkdir()
    assert set(versions.drop_old(spark, root, keep=2)) == set(staged[:2])
    assert [v.number for v in versions.published(spark, root)] == [3, 4] and left.exists()
    assert versions.drop_old(spark, root, keep=2, abandoned_hours=-1) == [str(left)]
    assert versions.publish(spark, root, versions.stage(root)).number == 6


def test_of_two_runs_on_one_version_only_one_publishes(spark, tmp_path):
    root = str(tmp_path / "v")
    versions.publish(spark, root, versions.stage(root))
    first, second = versions.stage(root), versions.stage(root)
    versions.publish(spark, root, first, after=1)
    with pytest.raises(versions.Outdated):
        versions.publish(spark, root, second, after=1)
    assert versions.current(spark, root).path == first


@pytest.mark.parametrize("name", ["publish", "_create"])
def test_a_table_is_replaced_all_at_once(spark, tmp_path, monkeypatch, name):
    df = spark.createDataFrame([("s", "old")], "sub string, obj string")
    table = f"replaced_{name.strip('_')}"
    sinks.save_table(df, table, str(tmp_path / "t"))
    with monkeypatch.context() as patch:
        killed_at(patch, versions, name)
        with pytest.raises(Killed):
            sinks.save_table(df.withColumn("obj", F.lit("new")), table, str(tmp_path / "t"))
    assert rows(spark.read.table(table), "obj") == Counter([("old",)])
    # Its own content may be read while it is replaced.
    sinks.save_table(spark.read.table(table).withColumn("obj", F.upper("obj")), table, str(tmp_path / "t"))
    assert rows(spark.read.table(table), "obj") == Counter([("OLD",)])
    sinks.save_table(df.withColumn("more", F.lit(1)), table, str(tmp_path / "t"))
    assert spark.read.table(table).columns == ["sub", "obj", "more"]


def test_stored_counts_equal_counts_of_the_text(spark, tmp_path):
    path = tmp_path / "a.nt"
    path.write_text("\n".join([*STAT_LINES, *REJECTED, "<https://kg.example/7>\t<http://h/tab>\t<o>\t."]) + "\n")
    bases = ["https://kg.example/", "https://kg.example/1", "https://nowhere/"]
    triples.ingest_triples(spark, {"a": str(path)}, str(tmp_path / "t"), bases=bases)
    for base in bases:
        wanted = predicate_stats_by_dump(spark, base, {"a": str(path)})
        stored = stored_predicate_stats(spark, base, {"a": str(tmp_path / "t/a")})
        assert rows(stored, "source", "pred", "n") == rows(wanted, "source", "pred", "n")
    triples.ingest_triples(spark, {"a": str(path)}, str(tmp_path / "t"))
    with pytest.raises(FileNotFoundError, match="without bases"):
        stored_predicate_stats(spark, bases[0], {"a": str(tmp_path / "t/a")})


def test_plain_lines_are_counted_without_a_search(spark, tmp_path, monkeypatch):
    path = tmp_path / "a.nt"
    path.write_text('<http://b/1-1> <http://n#p> <http://b/1-2> .\n<http://b/2-1> <http://n#q> "some  text"^^<http://t> .\n<http://c/1> <http://n#q> "x" .\n')
    monkeypatch.setattr(triples, "regex_group", lambda *_: F.raise_error(F.lit("searched")).cast("string"))
    bases = ["http://b/", "http://b/1-"]
    triples.ingest_triples(spark, {"a": str(path)}, str(tmp_path / "t"), bases=bases)
    counts = rows(triples.read_predicate_counts(spark, str(tmp_path / "t/a")), "base", "pred", "n")
    assert counts == Counter([("http://b/", "http://n#p", 1), ("http://b/", "http://n#q", 1), ("http://b/1-", "http://n#p", 1)])


def test_lines_count_for_what_the_pattern_finds(spark):
    """Plain lines are told without a search, by rules that hold for odd lines, too."""
    parts = ["<b/", "1", "> <", ">", "<", " ", ' "t" ', " .", "\u2003"]
    lines = ["<b/" + "".join(p) + end for n in range(1, 5) for p in itertools.product(parts, repeat=n) for end in (" .", "> .")]
    lines += [f"{s} {p} {o}" for s in ("<b/1>", "<b/>", "<c/1>", "<b/<b/1>", "<c/<b/>", "<b/1") for p in ("<p>", "<>", "p", "<p>\t<q>", "<p\tq>", "<b/1>")
              for o in ("<o> .", "<b/1> .", '"<b/1> <p> <o>" .', '"a > b" .', '"a < b"^^<t> .', ".", " .", "", "<o> . ", '"x"\t.', '"x"\t. .')]
    bases = ["b/", "b/1"]
    df = triples._lines_by_task(spark.createDataFrame([(line,) for line in lines], "value string"), bases)
    told = rows(triples._predicate_counts(df, bases), "base", "pred", "n")
    value = F.col("value")
    searched = Counter()
    for base in bases:
        iri = text.without_ends(text.regex_group(value, text.triple_pattern(base), 2))
        found = spark.createDataFrame([(line,) for line in lines], "value string").filter(value.rlike(text.triple_pattern(base)))
        searched += rows(found.select(F.lit(base).alias("base"), iri.alias("pred")).groupBy("base", "pred").count(), "base", "pred", "count")
    assert told == searched and len(told) > 10
    tokens = triples._with_tokens(spark.createDataFrame([(line,) for line in lines], "value string"))
    assert tokens.filter(text.is_plain_triple(F.col("first"), F.col("second"), F.col("rest"))).count() > 50


def test_sums_of_halves_are_sums_of_hashes(spark):
    df = spark.range(0, 3000).select((F.col("id") % 7).cast("string").alias("sub"), F.lit("p").alias("pred"), F.col("id").cast("string").alias("obj"))
    whole = df.groupBy("sub").agg(F.count("*").alias("n"), F.sum(F.xxhash64("pred", "obj").cast("decimal(38,0)")).alias("digest"))
    halves = triples.subject_digests(df)
    assert halves.dtypes == whole.dtypes and rows(halves, "sub", "n", "digest") == rows(whole, "sub", "n", "digest")


def test_a_new_version_is_stored_from_two_texts_of_its_dump(spark, monkeypatch):
    """The whole dump is written once and ingested as it is; what is stored is no longer kept as text."""
    written, real = [], fixtures.Fixtures.write_text
    monkeypatch.setattr(fixtures.Fixtures, "write_text", lambda *args: written.append(real(*args)) or written[-1])
    found = QUERIES["ingest_new_version"](spark, "/root/testdata/sf0.001")
    assert len(written) == 2 and not any(versions.exists(spark, path) for path in written)
    assert found.count() == fixtures.Fixtures(spark, "/root/testdata/sf0.001").organization().count()


def test_employee_report(spark, tmp_path):
    staff = [(1, "Ada", "Lark", 1), (2, "Bo", None, 3), (3, None, "Cole", 0), (4, "Di", "Marsh", None)]
    source, target = str(tmp_path / "employees"), str(tmp_path / "report")
    sinks.write_parquet(
        spark.createDataFrame(staff, "id long, first_name string, second_name string, floor long"), source
    )
    run_employee_report(spark, source, target, 21)
    report = spark.read.csv(target, header=True, schema="id long, name string, steps_to_desk long")
    assert rows(report, "id", "name", "steps_to_desk") == Counter(
        [(1, "Ada Lark", 21), (2, "Bo", 63), (3, "Cole", 0), (4, "Di Marsh", None)]
    )


def test_fixture_dumps_are_compressed_in_files_of_bounded_length(spark, monkeypatch):
    monkeypatch.setattr(fixtures, "LINES_PER_FILE", 1000)
    fx = fixtures.Fixtures(spark, "/root/testdata/sf0.001")
    rows = spark.range(0, 2500, 1, 1).select(F.col("id").cast("string").alias("sub"), F.lit("p").alias("pred"), F.lit("<o>").alias("obj"))
    path = Path(fx.write_lines(rows).removeprefix("file:"))
    assert [p.suffix for p in path.glob("part-*")] == [".gz"] * 3
    assert triples.read_lines(spark, str(path)).count() == 2500


def test_stored_lines_and_digests_are_packed(spark, dump, tmp_path):
    triples.ingest_triples(spark, {"organization": dump}, str(tmp_path))
    for part in ("lines", "subjects"):
        files = list(tmp_path.glob(f"organization/data/*/{part}/**/*.parquet"))
        assert files and all(".zstd." in p.name for p in files)


def test_patterns_of_lines_agree(spark):
    """Matches and groups are those of one search with lazy ends, over odd lines."""
    parts = ["<b/", "> <", ">", "< ", " .", "x", "\u2003"]
    lines = ["<b/" + "".join(p) for n in range(2, 7) for p in itertools.product(parts, repeat=n)]
    lines += [f"<b/1> <p> {o} ." for o in ("<o>", '"t> <u> v"', '"x"^^<y>', "<b/2> <q> <o>", '"a . b"', "")]
    space = r"[\s\x1c-\x1f]"
    first = rf"(?dU)<\Qb/\E(.+)>{space}(<.*?>){space}.*?{space}\."
    value, head = F.col("value"), F.col("head")
    df = spark.createDataFrame([(line,) for line in lines], "value string")
    df = df.withColumn("head", text.regex_group(value, text.triple_head_pattern("b/"), 1))
    counted = df.agg(
        F.count_if(value.rlike(first)).alias("matched"),
        F.count_if(value.rlike(first) != value.rlike(text.is_triple_pattern("b/"))),
        *[F.count_if(text.regex_group(value, first, i) != text.regex_group(value, text.triple_pattern("b/"), i)) for i in (1, 2)],
        *[F.count_if(text.regex_group(value, first, i) != text.regex_group(head, text.HEAD_PARTS, i)) for i in (1, 2)],
    ).first()
    assert counted[0] > 100 and counted[1:] == (0, 0, 0, 0, 0)
