"""Approximate nearest neighbours by cosine: NN-descent and greedy graph search.

Nodes of the graph are the distinct vectors, each with the smallest ids of its rows, so copies
need no edges and ties among them are settled by id. All comparisons but the last use the same
32-bit unit vectors.

Building the graph:

1. First neighbours come from ``N_TABLES`` partitions of the vectors by random hyperplanes;
   cells that are too large are cut by hash. Each cell finds the nearest within itself.
2. NN-descent: every node gathers its neighbours and the nearest of those it is a neighbour
   of, with their vectors, and compares them with each other: neighbours of neighbours. Only pairs
   of which at least one came into a list in the last round are new. Pairs that beat a node's worst
   neighbour go to that node, which keeps the ``K`` best; tasks keep the best for each node before
   they pass them on, so a node that is near to very many costs each task one list. This is repeated
   until a round changes at most ``SETTLED`` of all list entries, each round a chain of joins whose
   result is stored. An entry is replaced by a better one only, by more than rounding, so it ends.

Searching: each query node keeps a beam of the nearest nodes found. It starts from its own
node, whose neighbours in the graph are expanded first, and from a fixed number of entry
points. Every round expands the nearest nodes of each beam not expanded yet: joins with the graph
and with the vectors give the neighbours that the beam lacks, a bounded number for each query.
It ends when no beam has a node left to expand. The best of each beam are compared exactly in double
precision on the original vectors, scaled by powers of two, so that no square over- or underflows.

Defined results: rows with a null id, and vectors that are null, zero, or hold null or
non-finite components, take no part, nor do those whose length isn't the most common one.
Repeated rows are candidates of their own. Equal scores go to the smaller id. An empty table
gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from triplewright.session import materialize

# Neighbours of a node in the graph, and those it has in the search and in local joins, in
# which the nodes it is a neighbour of take part.
K = 24
MOST_EDGES = 40
N_TABLES = 12
CELL_ROWS = 1024
# Share of list entries that may be new in the last round of NN-descent, and by how much a new
# entry must be better: more than rounding.
SETTLED = 0.002
MARGIN = 1e-6
# Candidates that a node sends to another one in a local join.
SENT = 12
# Candidates that a task gathers before it keeps the best for each node.
TASK_CANDIDATES = 1 << 18
# Search: entry points, nodes of a beam, nodes expanded in a round.
ENTRIES = 512
BEAM = 192
EXPANDED = 48
# Queries that are compared with all entry points at once.
ENTRY_ROWS = 512
# Best of a beam that are compared exactly.
EXACT = 32
_LISTS = "node long, ids array<long>, scores array<float>"
_GRAPH = f"{_LISTS}, fresh array<boolean>"


def usable_vectors(df: DataFrame, key: str, vector: str) -> tuple[DataFrame, DataFrame]:
    """(key, class) of the rows that take part, and (node, class, vector, unit) of their distinct vectors.

    ``vector`` is scaled by a power of two, ``unit`` has packed 32-bit floats.
    """
    doubles = F.transform(vector, lambda x: x.cast("double"))
    rows = df.select(F.col(key).alias("key"), doubles.alias("vector")).filter("key IS NOT NULL AND vector IS NOT NULL")
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.filter(finite & F.exists("vector", lambda x: x != 0)).withColumn("length", F.size("vector"))
    lengths = rows.groupBy("length").agg(F.count("*").alias("n"))
    length = lengths.agg(F.max(F.struct("n", "length"))["length"]).first()[0] or 0

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("vector").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            _, exponents = np.frexp(np.abs(x).max(axis=1, keepdims=True))
            x = np.ldexp(x, -exponents) + 0.0  # one zero
            units = (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)
            columns = [batch.column("key"), pa.array([hashlib.blake2b(row.tobytes(), digest_size=16).digest() for row in x])]
            columns += [pa.array(list(x), pa.list_(pa.float64())), pa.array([row.tobytes() for row in units])]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "class", "vector", "unit"])

    kept = rows.filter(F.col("length") == length).select("key", "vector")
    kind = kept.schema["key"].dataType.simpleString()
    packed = materialize(kept.mapInArrow(pack, f"key {kind}, class binary, vector array<double>, unit binary"), "vectors")
    distinct = packed.groupBy("class").agg(F.first(F.struct("vector", "unit")).alias("own")).select("class", "own.vector", "own.unit")
    # Stored with their numbers, so that they stay the same.
    return packed.select("key", "class"), materialize(distinct.withColumn("node", F.monotonically_increasing_id()), "nodes")


def _matrix(units) -> np.ndarray:
    values = units.to_pylist() if hasattr(units, "to_pylist") else units
    return np.frombuffer(b"".join(values), dtype=np.float32).reshape(len(values), -1)


def _lists(nodes: np.ndarray, ids: np.ndarray, scores: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    """Rows of _LISTS from flat values and the number of each node's."""
    offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
    return pa.RecordBatch.from_arrays(
        [
            pa.array(nodes.astype(np.int64)),
            pa.ListArray.from_arrays(offsets, pa.array(ids.astype(np.int64))),
            pa.ListArray.from_arrays(offsets, pa.array(scores.astype(np.float32))),
        ],
        names=["node", "ids", "scores"],
    )


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Runs of rows with equal keys, in batches sorted by the keys."""
    rest: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if rest is not None and rest.num_rows:
            table = pa.concat_tables([rest, table])
        values = np.stack([table.column(k).to_numpy() for k in keys])
        cuts = np.flatnonzero((values[:, 1:] != values[:, :-1]).any(axis=0)) + 1
        at = 0
        for cut in cuts.tolist():
            yield table.slice(at, cut - at)
            at = cut
        rest = table.slice(at)
    if rest is not None and rest.num_rows:
        yield rest


def _best(owners: np.ndarray, ids: np.ndarray, scores: np.ndarray, fresh: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """The ``k`` best distinct ids of each owner, nearest first; an id that was there before isn't fresh."""
    order = np.lexsort((fresh, ids, owners))
    owners, ids, scores, fresh = (x[order] for x in (owners, ids, scores, fresh))
    first = np.ones(len(ids), dtype=bool)
    first[1:] = (ids[1:] != ids[:-1]) | (owners[1:] != owners[:-1])
    owners, ids, scores, fresh = (x[first] for x in (owners, ids, scores, fresh))
    order = np.lexsort((ids, -scores, owners))
    owners, ids, scores, fresh = (x[order] for x in (owners, ids, scores, fresh))
    starts = np.flatnonzero(np.diff(owners, prepend=-1))
    sizes = np.diff(np.append(starts, len(owners)))
    kept = np.arange(len(owners)) - np.repeat(starts, sizes) < k
    return owners[kept], ids[kept], scores[kept], fresh[kept]


def _task_best(lists: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """One list for each node in place of the many that a task finds."""
    gathered: list[tuple[np.ndarray, ...]] = []
    size = 0

    def reduced() -> tuple[np.ndarray, ...]:
        owners, ids, scores = (np.concatenate(x) for x in zip(*gathered))
        return _best(owners, ids, scores, np.zeros(len(ids), dtype=bool), k)[:3]

    def out() -> pa.RecordBatch:
        owners, ids, scores = reduced()
        nodes, counts = np.unique(owners, return_counts=True)
        return _lists(nodes, ids, scores, counts)

    for batch in lists:
        counts = batch.column("ids").value_lengths().to_numpy(zero_copy_only=False)
        gathered.append(
            (
                np.repeat(batch.column("node").to_numpy(), counts),
                batch.column("ids").flatten().to_numpy(),
                batch.column("scores").flatten().to_numpy(),
            )
        )
        size += len(gathered[-1][0])
        if size > TASK_CANDIDATES:
            gathered = [reduced()]
            size = len(gathered[0][0])
            if size > TASK_CANDIDATES // 2:
                yield out()
                gathered, size = [], 0
    if gathered:
        yield out()


def best_lists(found: DataFrame, k: int, graph: DataFrame | None = None) -> DataFrame:
    """One row per node: its ``k`` best distinct ids over all rows of the node, and of the graph so far; which of them are fresh."""
    rows = found.select("node", "ids", "scores", F.lit(True).alias("fresh"))
    if graph is not None:
        rows = rows.union(graph.select("node", "ids", "scores", F.lit(False)))
    gathered = rows.groupBy("node").agg(
        F.flatten(F.collect_list("ids")).alias("ids"),
        F.flatten(F.collect_list("scores")).alias("scores"),
        F.flatten(F.collect_list(F.array_repeat("fresh", F.size("ids")))).alias("fresh"),
    )

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes = batch.column("node").to_numpy()
            counts = batch.column("ids").value_lengths().to_numpy(zero_copy_only=False)
            values = [batch.column(name).flatten().to_numpy(zero_copy_only=False) for name in ("ids", "scores", "fresh")]
            owners, ids, scores, fresh = _best(np.repeat(np.arange(len(nodes)), counts), *values, k)
            lists = _lists(nodes, ids, scores, np.bincount(owners, minlength=len(nodes)))
            flags = pa.ListArray.from_arrays(lists.column("ids").offsets, pa.array(fresh.astype(bool)))
            yield lists.append_column("fresh", flags)

    return gathered.mapInArrow(choose, _GRAPH)


def _within(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.RecordBatch]:
    """Each cell's rows against each other, ``2 * CELL_ROWS`` at most at a time."""
    for cell in _groups(batches, keys):
        for at in range(0, cell.num_rows, 2 * CELL_ROWS):
            part = cell.slice(at, 2 * CELL_ROWS)
            nodes, x = part.column("node").to_numpy(), _matrix(part.column("unit"))
            if len(nodes) < 2:
                continue
            scores = x @ x.T
            np.fill_diagonal(scores, -2)
            k = min(K, len(nodes) - 1)
            best = np.argpartition(-scores, k - 1, axis=1)[:, :k]
            yield _lists(nodes, nodes[best].ravel(), np.take_along_axis(scores, best, axis=1).ravel(), np.full(len(nodes), k))


def first_neighbours(vectors: DataFrame, n: int, seed: int = 1) -> DataFrame:
    """The nearest within the cells of random hyperplanes."""
    bits = max(0, round(math.log2(max(1, n / CELL_ROWS))))

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("unit"))
            planes = np.random.default_rng(seed).standard_normal((x.shape[1], N_TABLES * bits))
            sides = (x @ planes > 0).reshape(len(x), N_TABLES, bits)
            codes = (sides * (1 << np.arange(bits))).sum(axis=2) + (np.arange(N_TABLES) << 40)
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), pa.array(list(codes.astype(np.int64)))], names=["node", "cells"]
            )

    cells_of = vectors.select("node", "unit").mapInArrow(cells, "node long, cells array<long>")
    placed = materialize(cells_of.select("node", F.explode("cells").alias("cell")), "cells")
    sizes = placed.groupBy("cell").agg(F.ceil(F.count("*") / (1.5 * CELL_ROWS)).alias("parts"))
    placed = placed.join(sizes, "cell").withColumn("part", F.pmod(F.xxhash64("node", "cell"), F.col("parts")))
    rows = placed.select("node", "cell", "part").join(vectors.select("node", "unit"), "node")
    rows = rows.repartition("cell", "part").sortWithinPartitions("cell", "part", "node")
    found = rows.select("cell", "part", "node", "unit").mapInArrow(
        lambda b: _task_best(_within(b, ["cell", "part"]), K), _LISTS
    )
    return materialize(best_lists(found, K), "graph")


def edges(graph: DataFrame) -> DataFrame:
    """(node, other, fresh): each node's neighbours and the nearest nodes it is a neighbour of, up to MOST_EDGES."""
    forward = graph.select("node", F.explode(F.arrays_zip("ids", "scores", "fresh")).alias("to"))
    forward = forward.select("node", F.col("to.ids").alias("other"), F.col("to.scores").alias("score"), F.col("to.fresh").alias("fresh"))
    both = forward.withColumn("back", F.lit(0)).union(
        forward.select(F.col("other").alias("node"), F.col("node").alias("other"), "score", "fresh", F.lit(1))
    )
    distinct = both.groupBy("node", "other").agg(
        F.max("score").alias("score"), F.min("back").alias("back"), F.bool_or("fresh").alias("fresh")
    )
    nearest = Window.partitionBy("node").orderBy("back", F.col("score").desc(), "other")
    return distinct.withColumn("place", F.row_number().over(nearest)).filter(F.col("place") <= MOST_EDGES).select("node", "other", "fresh")


def _local_join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Neighbours of one node against each other, but for pairs that met before; what beats the worst neighbour of either."""
    for group in _groups(batches, ["node"]):
        members, worst = group.column("other").to_numpy(), group.column("worst").to_numpy()
        fresh = group.column("fresh").to_numpy()
        x = _matrix(group.column("unit"))
        scores = x @ x.T
        np.fill_diagonal(scores, -2)
        scores[(scores <= worst[:, None] + MARGIN) | ~(fresh[:, None] | fresh)] = -2
        k = min(SENT, len(members))
        best = np.argpartition(-scores, k - 1, axis=1)[:, :k]
        values = np.take_along_axis(scores, best, axis=1)
        good = values > -2
        counts = good.sum(axis=1)
        if counts.any():
            yield _lists(members, members[best][good], values[good], counts)


def descend(graph: DataFrame, vectors: DataFrame) -> DataFrame:
    """One round of NN-descent."""
    full = F.size("ids") >= K
    worst = graph.select(F.col("node").alias("other"), F.when(full, F.array_min("scores")).otherwise(-2.0).cast("float").alias("worst"))
    sent = vectors.select(F.col("node").alias("other"), "unit").join(worst, "other", "left").fillna(-2.0, ["worst"])
    any_fresh = F.bool_or("fresh").over(Window.partitionBy("node"))
    active = edges(graph).withColumn("active", any_fresh).filter("active").drop("active")
    gathered = active.join(sent, "other").repartition("node").sortWithinPartitions("node", "other")
    found = gathered.select("node", "other", "fresh", "worst", "unit").mapInArrow(
        lambda b: _task_best(_local_join(b), K), _LISTS
    )
    return materialize(best_lists(found, K, graph), "graph")


def _fresh_share(graph: DataFrame) -> float:
    """Share of the list entries that the last round has brought."""
    fresh = F.size(F.filter("fresh", lambda flag: flag))
    row = graph.agg(F.sum(fresh).alias("fresh"), F.sum(F.size("ids")).alias("n")).first()
    return (row["fresh"] or 0) / (row["n"] or 1)


def build_graph(vectors: DataFrame, settled: float = SETTLED) -> DataFrame:
    """(node, ids, scores, fresh): the approximate K nearest neighbours of each node that has any."""
    graph = first_neighbours(vectors, vectors.count())
    while _fresh_share(graph) > settled:
        graph = descend(graph, vectors)
    return graph


# Searching


_BEAMS = "node long, unit binary, ids array<long>, scores array<float>, done array<boolean>"
_BEAM_TYPES = [pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.float32()), pa.list_(pa.bool_())]
_BEAM_NAMES = ["node", "unit", "ids", "scores", "done"]


def _first_beams(queries: DataFrame, entries: list) -> DataFrame:
    """Beams of each query's own node and the best entry points."""
    ids, x = np.array([row["node"] for row in entries], dtype=np.int64), _matrix([bytes(row["unit"]) for row in entries])

    def start(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, ENTRY_ROWS):
                batch = whole.slice(at, ENTRY_ROWS)
                own = batch.column("node").to_numpy()[:, None]
                scores = _matrix(batch.column("unit")) @ x.T
                scores[ids == own] = -2
                best = np.argsort(-scores, axis=1)[:, : EXPANDED - 1]
                values = np.take_along_axis(scores, best, axis=1)
                chosen = [np.append(node, ids[row[score > -2]]) for node, row, score in zip(own[:, 0], best, values)]
                found = [np.append(np.float32(1), score[score > -2]) for score in values]
                columns = [batch.column("node"), batch.column("unit"), chosen, found, [np.zeros(len(c), dtype=bool) for c in chosen]]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _BEAM_TYPES)], names=_BEAM_NAMES)

    return queries.select("node", "unit").mapInArrow(start, _BEAMS)


def _next(done) -> np.ndarray:
    """Places of a beam, nearest first, to expand next."""
    return np.flatnonzero(~np.asarray(done, dtype=bool))[:EXPANDED]


def _frontier(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(query, node) of the nodes to expand."""
    for batch in batches:
        nodes, ids, done = (batch.column(c).to_pylist() for c in ("node", "ids", "done"))
        chosen = [[own[i] for i in _next(flags)] for own, flags in zip(ids, done)]
        queries = [node for node, own in zip(nodes, chosen) for _ in own]
        others = [other for own in chosen for other in own]
        yield pa.RecordBatch.from_arrays([pa.array(queries, pa.int64()), pa.array(others, pa.int64())], names=["query", "node"])


def _advance(beam: pa.Table, found: pa.Table) -> pa.Table:
    """The best of a query's beam and of the vectors found for it; nodes expanded in this round are marked."""
    ids, scores = (np.array(beam[name][0].as_py()) for name in ("ids", "scores"))
    done = np.array(beam["done"][0].as_py(), dtype=bool)
    done[_next(done)] = True
    if found.num_rows:
        near = _matrix(found["unit"]) @ _matrix(beam["unit"])[0]
        ids = np.concatenate([ids, found["other"].to_numpy()])
        scores = np.concatenate([scores, near])
        done = np.concatenate([done, np.zeros(len(near), dtype=bool)])
    best = np.lexsort((ids, -scores))[:BEAM]
    columns = [beam["node"].combine_chunks(), beam["unit"].combine_chunks(), [ids[best]], [scores[best]], [done[best]]]
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, _BEAM_TYPES)], names=_BEAM_NAMES)


def search(queries: DataFrame, vectors: DataFrame, graph: DataFrame) -> DataFrame:
    """(node, ids, scores): the beam of each query node, nearest first, itself included."""
    adjacency = materialize(edges(graph).groupBy("node").agg(F.collect_list("other").alias("others")), "adjacency")
    entries = vectors.select("node", "unit").orderBy(F.xxhash64("node")).limit(ENTRIES).collect()
    if not entries:
        return queries.select("node", F.array().cast("array<long>").alias("ids"), F.array().cast("array<float>").alias("scores"))
    units = vectors.select(F.col("node").alias("other"), "unit")
    beams = materialize(_first_beams(queries, entries), "beams")
    while not beams.filter(F.exists("done", lambda flag: ~flag)).isEmpty():
        frontier = beams.select("node", "ids", "done").mapInArrow(_frontier, "query long, node long")
        # At most EXPANDED * MOST_EDGES nodes for each query.
        wanted = frontier.join(adjacency, "node").groupBy("query").agg(F.array_distinct(F.flatten(F.collect_list("others"))).alias("others"))
        lacking = wanted.join(beams.select(F.col("node").alias("query"), "ids"), "query").select(
            "query", F.explode(F.array_except("others", "ids")).alias("other")
        )
        found = lacking.join(units, "other")
        beams = materialize(beams.groupBy("node").cogroup(found.groupBy("query")).applyInArrow(_advance, _BEAMS), "beams")
    return beams.select("node", "ids", "scores")


def exact_nearest(beams: DataFrame, vectors: DataFrame, members: DataFrame, k: int) -> DataFrame:
    """(node, found): for each query node the ``k + 1`` nearest rows as (score, key, node), its own rows included, by exact cosine.

    ``members`` has the smallest ``k + 1`` keys of each node.
    """
    pairs = beams.select(F.col("node").alias("query"), F.explode(F.slice("ids", 1, EXACT)).alias("node"))
    own = vectors.select(F.col("node").alias("query"), F.col("vector").alias("a"))
    other = vectors.select("node", F.col("vector").alias("b"))

    def dot(x: str, y: str):
        return F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda total, v: total + v)

    cosine = dot("a", "b") / (F.sqrt(dot("a", "a")) * F.sqrt(dot("b", "b")))
    scored = pairs.join(own, "query").join(other, "node").select("query", "node", cosine.alias("score"))
    rows = scored.join(members, "node").select("query", "node", "score", F.explode("keys").alias("key"))
    near = Window.partitionBy("query").orderBy(F.col("score").desc(), "key")
    best = rows.withColumn("place", F.row_number().over(near)).filter(F.col("place") <= k + 1)
    listed = F.sort_array(F.collect_list(F.struct("place", "key", "score", "node")))
    return best.groupBy("query").agg(listed.alias("found")).withColumnRenamed("query", "node")


def nearest(df: DataFrame, is_query: str, k: int, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` approximate nearest rows of each row for which the SQL
    condition ``is_query`` on the column ``key`` holds."""
    rows, nodes = usable_vectors(df, key, vector)
    graph = build_graph(nodes)
    asking = rows.withColumnRenamed("key", key).filter(is_query).withColumnRenamed(key, "key")
    asking = materialize(asking.join(nodes.select("class", "node"), "class").select("key", "node"), "queries")
    own = asking.select("node").distinct().join(nodes.select("node", "unit"), "node")
    # The window is cut within each task first, so a node of very many rows sends few.
    smallest = F.row_number().over(Window.partitionBy("class").orderBy("key"))
    members = rows.withColumn("place", smallest).filter(F.col("place") <= k + 1).join(nodes.select("class", "node"), "class")
    members = materialize(members.groupBy("node").agg(F.sort_array(F.collect_list("key")).alias("keys")), "members")
    found = exact_nearest(search(own, nodes, graph), nodes, members, k)
    # A row is no neighbour of itself: of its own node's rows one with its id is left out.
    answers = asking.join(found, "node")
    itself = F.array_min(F.transform(F.filter("found", lambda x: (x["node"] == F.col("node")) & (x["key"] == F.col("key"))), lambda x: x["place"]))
    others = F.slice(F.filter("found", lambda x: x["place"] != F.coalesce("itself", F.lit(0))), 1, k)
    ranked = answers.withColumn("itself", itself).select(F.col("key").alias("query_id"), F.posexplode(others).alias("place", "row"))
    return ranked.select("query_id", (F.col("place") + 1).alias("rank"), F.col("row.key").alias("vec_id"), F.col("row.score").alias("score"))
