"""Mixing sources to target weights by Pareto order sampling.

1. Targets. Sources take shares of the total size by weight, no more than ``max_copies``
   times their own size; what a full source can't take is shared among the others by weight
   (the water level, found by a few small aggregations over the sources).
2. Certain copies. Within a source, a document of weight class w is to be taken
   ``min(max_copies, c * w)`` times on average, with c such that the source meets its target.
   The whole part of that number is taken for certain.
3. Pareto order sampling. The fraction left is a document's inclusion probability p. With a
   uniform number u from a hash of the document, its rank is the odds of u over the odds of
   p; a source takes its documents in rank order as long as they fit into what is left of
   its target. What the first document beyond leaves open is filled in the same way from the
   documents that are short enough, a few times over, and at last by one document more if that
   comes nearer. Size is thus fixed up to a short document, probabilities differ by class.

A cut in rank order is found without sorting a source: words are summed over a histogram
of ranks, then over a histogram of the one cell that holds the cut, and only what
shares a cell of the second with the cut is ordered. Sources may be of any size.

Defined results: a null text has size 0; documents of size 0 take part and are taken 0
words. Null sources form a source of their own, last in order. Equal rows are numbered
and drawn one by one, so the result as a set of rows is the same in each run. An empty
table gives an empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from triplewright.session import materialize

MAX_COPIES = 3
SEED = 20260
# Weight classes 1 ... N_CLASSES of documents.
N_CLASSES = 32
# Cells of each of the two histograms of ranks.
CELLS = 4096
# How often what is left of a target is filled with shorter documents.
FILLS = 3
# Parts over which the copies of one record are dealt at most.
RECORD_PARTS = 4096


def word_count(text: Column) -> Column:
    """Number of words: longest runs without space and controls 9 to 13."""
    spaced = F.translate(F.coalesce(text, F.lit("")), "\t\n\x0b\f\r", "     ")
    # One separator before every word: count where a space is followed by something else.
    return F.regexp_count(spaced, F.lit("[^ ]+")).cast("long")


def length_class(size: Column) -> Column:
    """Weight class by order of magnitude: long documents are preferred, by a logarithm only."""
    return F.least(F.lit(N_CLASSES), F.floor(F.log2(size + F.lit(1))).cast("int") + 1)


def _source_numbers(sources: DataFrame) -> DataFrame:
    """Add ``number``: the place of each source by code point, null last, from 0.

    Spark orders strings by their UTF-8 bytes, that is by code point. Sources are sorted in
    ranges; each range is numbered by itself and shifted by the ranges before it.
    """
    ranged = sources.repartitionByRange(F.col("source").asc_nulls_last()).withColumn("range", F.spark_partition_id())
    ranged = materialize(ranged, "sources")
    counts = {row["range"]: row["count"] for row in ranged.groupBy("range").count().collect()}
    shifts, before = [], 0
    for number in sorted(counts):
        shifts.append((number, before))
        before += counts[number]
    shift = F.broadcast(sources.sparkSession.createDataFrame(shifts, "range int, shift long"))
    place = F.row_number().over(Window.partitionBy("range").orderBy(F.col("source").asc_nulls_last()))
    return ranged.withColumn("place", place).join(shift, "range").withColumn("number", F.col("place") + F.col("shift") - 1).drop("place", "shift", "range")


def targets(sources: DataFrame, weights: tuple[float, ...] = (1.0, 2.0, 3.0), max_copies: int = MAX_COPIES) -> DataFrame:
    """(source, source_size) -> the same with ``target``; weights repeat along the order of sources."""
    listed = F.array(*[F.lit(float(w)) for w in weights])
    weighed = materialize(
        _source_numbers(sources)
        .withColumn("weight", F.get(listed, F.pmod("number", F.lit(len(weights))).cast("int")))
        .withColumn("most", (F.col("source_size") * max_copies).cast("double"))
        .drop("number"),
        "weighed",
    )
    total = weighed.agg(F.sum("source_size")).first()[0] or 0
    level, full = 0.0, -1
    while True:
        # Sources below the level stay full as it rises, so this ends.
        is_full = F.col("most") <= F.col("weight") * level
        row = weighed.agg(
            F.sum(F.when(is_full, 1).otherwise(0)).alias("n"),
            F.sum(F.when(is_full, F.col("most")).otherwise(0.0)).alias("taken"),
            F.sum(F.when(is_full, 0.0).otherwise(F.col("weight"))).alias("weight"),
        ).first()
        if not row["weight"] or row["n"] == full:
            break
        level, full = (total - row["taken"]) / row["weight"], row["n"]
    target = F.least(F.col("most"), F.col("weight") * level) if total else F.lit(0.0)
    return weighed.select("source", "source_size", target.alias("target"))


def _class_rates(classes: DataFrame, max_copies: int) -> DataFrame:
    """(source, class, class_size, target) -> expected copies of each class's documents.

    Classes are few per source. Classes from the heaviest down are filled to ``max_copies``
    as long as the scale that then meets the rest of the target would overfill them.
    """
    by_weight = Window.partitionBy("source").orderBy(F.col("class").desc())
    whole = Window.partitionBy("source")
    above = F.sum("class_size").over(by_weight.rowsBetween(Window.unboundedPreceding, -1))
    prepared = (
        classes.withColumn("above", F.coalesce(above, F.lit(0)))
        .withColumn("weighed", F.sum(F.col("class_size") * F.col("class")).over(by_weight.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("scale", F.when(F.col("weighed") > 0, (F.col("target") - F.col("above") * max_copies) / F.col("weighed")))
    )
    # The first class, from the heaviest, that isn't overfilled sets the scale for all below.
    fits = F.col("scale") * F.col("class") <= max_copies
    chosen = prepared.withColumn("chosen", F.max(F.when(fits, F.struct("class", "scale"))).over(whole))
    rate = F.when(F.col("chosen").isNull(), F.lit(float(max_copies))).when(
        F.col("class") > F.col("chosen.class"), F.lit(float(max_copies))
    ).otherwise(F.greatest(F.lit(0.0), F.col("chosen.scale") * F.col("class")))
    return chosen.select("source", "class", rate.alias("rate"))


def _join_sources(df: DataFrame, other: DataFrame, *more: str, how: str = "inner") -> DataFrame:
    """Join on source, nulls included, and on other columns. ``other`` has a row for each source
    (and class), and adaptive execution picks the join by its size."""
    renamed = other.withColumnRenamed("source", "__source")
    for name in more:
        renamed = renamed.withColumnRenamed(name, f"__{name}")
    conditions = [df["source"].eqNullSafe(renamed["__source"]), *(df[name] == renamed[f"__{name}"] for name in more)]
    return df.join(renamed, reduce(Column.__and__, conditions), how).drop("__source", *(f"__{name}" for name in more))


def _left_sources(df: DataFrame, other: DataFrame) -> DataFrame:
    return _join_sources(df, other, how="left")


def _told_apart(docs: DataFrame) -> DataFrame:
    """Add ``lot``: the record hash, for repeated records hashed again with their number 0, 1, ….

    Repeated records are numbered within (record, part) and shifted by the parts before, so
    no group holds all copies.
    """
    repeated = docs.groupBy("record").agg(F.count("*").alias("n")).filter("n > 1").select("record")
    repeated = materialize(repeated, "repeated")
    if repeated.isEmpty():
        return docs.withColumn("lot", F.col("record")).drop("part")
    copies = materialize(docs.join(repeated, "record"), "copies")
    before = Window.partitionBy("record").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = copies.groupBy("record", "part").agg(F.count("*").alias("n"))
    shifts = shifts.withColumn("shift", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    place = F.row_number().over(Window.partitionBy("record", "part").orderBy("size"))
    numbered = copies.withColumn("place", place).join(shifts, ["record", "part"])
    lots = numbered.withColumn("lot", F.xxhash64("record", F.col("place") + F.col("shift"))).drop("place", "shift", "part")
    single = docs.join(repeated, "record", "left_anti").withColumn("lot", F.col("record")).drop("part")
    return materialize(single.unionByName(lots), "lots")


def _cut_cells(candidates: DataFrame, cell: str, need: str) -> DataFrame:
    """Per source: the cell in which the running words pass ``need``, and what is needed within it."""
    sums = candidates.groupBy("source", cell, need).agg(F.sum("size").alias("words"))
    before = Window.partitionBy("source").orderBy(cell).rowsBetween(Window.unboundedPreceding, -1)
    running = sums.withColumn("before", F.coalesce(F.sum("words").over(before), F.lit(0)))
    beyond = running.filter(F.col("before") + F.col("words") > F.col(need))
    rest = (F.col(need) - F.col("before")).alias("rest")
    return beyond.groupBy("source").agg(F.min(F.struct(cell, rest)).alias("cut")).select(
        "source", F.col(f"cut.{cell}").alias(f"cut_{cell}"), F.col("cut.rest").alias(f"{cell}_need")
    )


def _draw(ranked: DataFrame, last: bool) -> DataFrame:
    """Set ``more`` to 1 for further documents, in rank order, until ``left`` is met.

    The document that passes ``left`` is taken in the ``last`` draw only, if that comes nearer.
    """
    short = F.col("size") <= F.col("left") * (2 if last else 1)
    candidate = F.expr("rank IS NOT NULL AND size > 0 AND more = 0") & short
    open_ = ranked.withColumn("candidate", candidate)
    candidates = open_.filter("candidate")
    coarse = materialize(_cut_cells(candidates, "cell", "left"), "cuts")
    in_cell = _join_sources(candidates, coarse).filter("cell = cut_cell")
    cuts = materialize(_join_sources(coarse, _cut_cells(in_cell, "fine", "cell_need")), "cuts")
    at_cut = _join_sources(candidates, cuts).filter("cell = cut_cell AND fine = cut_fine")
    order = Window.partitionBy("source").orderBy("rank", "lot")
    through = F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0))
    fits = F.col("through") - (F.col("size") / 2 if last else 0) <= F.col("fine_need")
    reached = (
        at_cut.withColumn("through", through).filter(fits).groupBy("source").agg(F.max(F.struct("rank", "lot")).alias("upto"))
    )
    cuts = _left_sources(cuts, reached)
    drawn = _left_sources(open_, materialize(cuts.drop("cell_need", "fine_need"), "cuts"))
    before_cut = F.expr("cut_cell IS NULL OR cell < cut_cell OR (cell = cut_cell AND fine < cut_fine)")
    at_most = F.expr("cell = cut_cell AND fine = cut_fine AND struct(rank, lot) <= upto")
    taken = F.col("candidate") & F.coalesce(before_cut | at_most, F.lit(False))
    more = F.when(taken, 1).otherwise(F.col("more"))
    drawn = materialize(drawn.withColumn("more", more).drop("candidate", "left", "cut_cell", "cut_fine", "upto"), "drawn")
    words = drawn.groupBy("source").agg(F.sum(F.col("size") * F.col("more")).alias("words"))
    return _join_sources(drawn, words).withColumn("left", F.col("need") - F.col("words")).drop("words")


def pareto_mix(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple[float, ...] = (1.0, 2.0, 3.0),
    max_copies: int = MAX_COPIES,
    seed: int = SEED,
) -> DataFrame:
    """Per row: ``key``, record (hash of key and text), size, source, source_size, target and copies."""
    docs = materialize(
        df.select(
            F.col(key).alias("key"),
            F.xxhash64(F.lit(seed), F.col(key), F.col(text)).alias("record"),
            F.col(source).alias("source"),
            word_count(F.col(text)).alias("size"),
        )
        .withColumn("class", length_class(F.col("size")))
        .withColumn("part", F.pmod(F.spark_partition_id(), F.lit(16))),
        "mix_documents",
    )
    docs = _told_apart(docs)
    class_sizes = materialize(docs.groupBy("source", "class").agg(F.sum("size").alias("class_size")), "class_sizes")
    sources = class_sizes.groupBy("source").agg(F.sum("class_size").alias("source_size"))
    goals = materialize(targets(sources, weights, max_copies), "targets")
    rates = _class_rates(_join_sources(class_sizes, goals), max_copies)
    # Rounding of rates must not push a whole number below itself.
    planned = materialize(
        _join_sources(rates, goals)
        .withColumn("certain", F.least(F.lit(max_copies), F.floor(F.col("rate") + 1e-9).cast("int")))
        .withColumn("p", F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("rate") - F.col("certain")))),
        "planned",
    )
    certain_words = (
        _join_sources(class_sizes, planned.select("source", "class", "certain"), "class")
        .groupBy("source")
        .agg(F.sum(F.col("class_size") * F.col("certain")).alias("certain_words"))
    )
    planned = _join_sources(planned, certain_words).withColumn("need", F.greatest(F.lit(0.0), F.col("target") - F.col("certain_words")))
    uniform = (F.pmod("lot", F.lit(1 << 52)) + 0.5) / float(1 << 52)
    odds = F.col("uniform") / (1 - F.col("uniform"))
    rank = F.when(F.col("p") >= 1, 0.0).when(F.col("p") > 1e-9, odds / (F.col("p") / (1 - F.col("p"))))
    # Ranks in [0, infinity) to [0, 1), in order; where nothing is left to draw there is no rank.
    ranked = _join_sources(docs, planned, "class").withColumn("uniform", uniform).withColumn("rank", rank)
    scaled = F.col("rank") / (1 + F.col("rank")) * CELLS
    ranked = materialize(
        ranked.withColumn("cell", F.least(F.lit(CELLS - 1), F.floor(scaled).cast("int")))
        .withColumn("fine", F.least(F.lit(CELLS - 1), F.floor((scaled - F.col("cell")) * CELLS).cast("int")))
        .withColumns({"more": F.lit(0), "left": F.col("need")})
        .select(
            *("key", "record", "lot", "source", "source_size", "size", "target", "certain", "need", "rank", "cell", "fine"),
            *("more", "left"),
        ),
        "ranked",
    )
    for draw in range(FILLS + 1):
        ranked = _draw(ranked, last=draw == FILLS)
    copies = F.least(F.lit(max_copies), F.col("certain") + F.col("more"))
    return ranked.select(F.col("key").alias(key), "record", "size", "source", "source_size", "target", copies.alias("copies"))


def mixed_rows(df: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """The rows of ``df``, each as often as the mix takes it; rows without words stay once."""
    seed = options.get("seed", SEED)
    taken = pareto_mix(df, key, text, source, **options)
    taken = taken.select("record", F.when(F.col("size") == 0, 1).otherwise(F.col("copies")).alias("copies"))
    # Equal records are interchangeable: their copies are counted together and dealt evenly.
    per_record = taken.groupBy("record").agg(F.sum("copies").alias("__copies"), F.count("*").alias("__rows"))
    single = df.withColumns(
        {
            "__record": F.xxhash64(F.lit(seed), F.col(key), F.col(text)),
            "__part": F.pmod(F.spark_partition_id(), F.lit(RECORD_PARTS)),
        }
    )
    joined = single.join(per_record.withColumnRenamed("record", "__record"), "__record")
    alone = joined.filter("__rows = 1").withColumn("__own", F.col("__copies"))
    # Numbered within (record, part) and shifted by the parts before, so that no task has all copies.
    # Stored with their parts, as they are read twice.
    several = materialize(joined.filter("__rows > 1"), "several")
    group = ["__record", "__part"]
    before = Window.partitionBy("__record").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = several.groupBy(*group).agg(F.count("*").alias("__n")).withColumn("__shift", F.coalesce(F.sum("__n").over(before), F.lit(0)))
    place = F.row_number().over(Window.partitionBy(*group).orderBy(F.lit(0))) + F.col("__shift")
    several = several.join(shifts.drop("__n"), group).withColumn("__place", place)
    share = F.floor(F.col("__copies") / F.col("__rows")) + (F.col("__place") <= F.pmod("__copies", F.col("__rows"))).cast("long")
    several = several.withColumn("__own", share)
    dealt = alone.select(*df.columns, "__own").union(several.select(*df.columns, "__own")).filter("__own > 0")
    return dealt.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__own").cast("long")))).select(*df.columns)
