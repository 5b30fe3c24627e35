"""Joins and per-key windows that stay balanced when one key holds a large share of the rows.

Keys are first counted in a fixed number of cells of their hash. Only the keys of cells that are
large enough to hold a hot one go on to a frequent-items sketch per frame (partial aggregation, no shuffle
of keys); sketches that were stored with the rows need neither. The sketch only decides how the work
is split, never what comes out: the hot list is collected once and used for both sides, so an
estimate that is off costs balance, not rows. At most ``1 / HOT_SHARE`` keys can hold
``HOT_SHARE`` of the rows each, which bounds the list.
"""

from __future__ import annotations

import math
from collections.abc import Collection
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from triplewright.operators.bloom import bloom_filter, n_blocks, split_by_filter
from triplewright.session import materialize

# A key is hot from this share of its frame on ...
HOT_SHARE = 1 / 1000
# ... provided it has this many rows; below, one task copes easily.
HOT_MIN_ROWS = 1_000_000
# Leading bits of a key's hash by which rows are counted first: cells of a quarter of HOT_SHARE.
CELL_BITS = 12
# Counters kept by the sketch; its error is far below HOT_SHARE.
SKETCH_ITEMS = 10_000
# Tasks that merge the sketches of all input tasks before the final merge.
SKETCH_MERGERS = 64
# Largest lookup side that may be broadcast, in bytes of its values.
BROADCAST_MAX_BYTES = 64 * 1024 * 1024


def _columns(on: str | list[str]) -> list[str]:
    return [on] if isinstance(on, str) else list(on)


def key_hash(*on: str | Column) -> Column:
    return F.xxhash64(*on)


@dataclass(frozen=True)
class KeySketch:
    """Stored sketches (n, sketch) of the keys of some rows, as made by :func:`sketch_keys`.

    ``whole`` is false where only a part of the sketched rows is used: shares are then
    unknown, and every key that is large in itself counts as hot. ``total`` is the number of
    rows, if it is known: so few that none can be hot need no look at the sketches.
    """

    states: DataFrame
    whole: bool = True
    total: int | None = None

    def may_have_hot_keys(self) -> bool:
        return self.total is None or self.total >= HOT_MIN_ROWS


def sketch_keys(hashed: DataFrame, by: list[str]) -> DataFrame:
    """(*by, n, bytes, sketch): mergeable sketches of the hashes ``h`` in each group, and sums of ``bytes``.

    Two steps, so that no task merges the states of all input tasks.
    """
    return combine_sketches(hashed.groupBy(*by, merger()).agg(*accumulated("h")), by)


def merger() -> Column:
    """The number of the first merge that a task's states go to."""
    return F.pmod(F.spark_partition_id(), F.lit(SKETCH_MERGERS)).alias("merger")


def accumulated(h: str, prefix: str = "") -> list[Column]:
    """The sketch of a column's hashes, their number, and the sum of their ``bytes``; rows without a hash are left out."""
    held = f"FILTER (WHERE {h} IS NOT NULL)"
    return [
        F.expr(f"approx_top_k_accumulate({h}, {SKETCH_ITEMS}) {held}").alias(f"{prefix}sketch"),
        F.count(h).alias(f"{prefix}n"),
        F.expr(f"sum(bytes) {held}").alias(f"{prefix}bytes"),
    ]


def combine_sketches(states: DataFrame, by: list[str]) -> DataFrame:
    """One row for each group of states (*by, n, bytes, sketch)."""
    return states.groupBy(*by).agg(
        F.expr(f"approx_top_k_combine(sketch, {SKETCH_ITEMS})").alias("sketch"),
        F.sum("n").alias("n"),
        F.sum("bytes").alias("bytes"),
    )


def _cell(h: Column) -> Column:
    return F.shiftrightunsigned(h, 64 - CELL_BITS)


def _large_cells(hashed: dict[int, DataFrame]) -> tuple[dict[int, int], dict[int, list[int]]]:
    """Rows of each frame (h), and its cells that have as many rows as a hot key. One job, if there are frames."""
    if not hashed:
        return {}, {}
    keyed = reduce(DataFrame.union, [df.select(F.lit(i).alias("frame"), _cell(F.col("h")).alias("cell")) for i, df in hashed.items()])
    total = F.sum("n").over(Window.partitionBy("frame"))
    counted = keyed.groupBy("frame", "cell").agg(F.count("*").alias("n")).withColumn("total", total)
    large = F.col("n") >= F.greatest(F.col("total") * HOT_SHARE, F.lit(HOT_MIN_ROWS))
    # Fewer than one cell in 1 / HOT_SHARE can be large.
    found = counted.filter(large).groupBy("frame").agg(F.first("total").alias("total"), F.collect_list("cell").alias("cells")).collect()
    return {row["frame"]: row["total"] for row in found}, {row["frame"]: row["cells"] for row in found}


def hot_keys(frames: list[DataFrame | KeySketch], on: str | list[str]) -> list[dict[int, int]]:
    """For each frame: hash of every hot key -> number of slices its rows deserve. One job, two with large cells.

    Frames are scanned for the columns ``on``; of stored sketches only the sketches are read.
    """
    on = _columns(on)
    hashed = {i: df.select(key_hash(*on).alias("h")) for i, df in enumerate(frames) if isinstance(df, DataFrame)}
    totals, cells = _large_cells(hashed)
    scanned = [
        hashed[i].filter(_cell(F.col("h")).isin(own)).select(F.lit(i).alias("frame"), "h", F.lit(0).cast("long").alias("bytes"))
        for i, own in cells.items()
    ]
    states = [
        df.states.select(F.lit(i).alias("frame"), "sketch", "n")
        for i, df in enumerate(frames)
        if isinstance(df, KeySketch) and df.may_have_hot_keys()
    ]
    several = bool(states)  # of a frame
    if scanned:
        states.append(sketch_keys(reduce(DataFrame.union, scanned), ["frame"]).select("frame", "sketch", "n"))
    if not states:
        return [{} for _ in frames]
    combined = reduce(DataFrame.union, states)
    if several:
        combine = F.expr(f"approx_top_k_combine(sketch, {SKETCH_ITEMS})").alias("sketch")
        combined = combined.groupBy("frame").agg(combine, F.sum("n").alias("n"))
    sketches = combined.select(
        "frame", "n", F.expr(f"approx_top_k_estimate(sketch, {math.ceil(1 / HOT_SHARE)})").alias("top")
    ).collect()
    found: list[dict[int, int]] = [{} for _ in frames]
    for row in sketches:
        frame = frames[row["frame"]]
        whole = not isinstance(frame, KeySketch) or frame.whole
        floor = max(totals.get(row["frame"], row["n"]) * HOT_SHARE, HOT_MIN_ROWS) if whole else HOT_MIN_ROWS
        found[row["frame"]] = {
            item["item"]: math.ceil(item["count"] / floor)
            for item in row["top"]
            if item["item"] is not None and item["count"] >= floor
        }
    return found


def scanned_once(
    rows: DataFrame, probe: DataFrame | KeySketch, name: str
) -> tuple[DataFrame, DataFrame | KeySketch]:
    """The rows, and where to look for their hot keys.

    With stored sketches both stay. Otherwise the rows are written out, so that the search for hot keys does
    not derive them a second time.
    """
    if isinstance(probe, KeySketch):
        return rows, probe
    rows = materialize(rows, name)
    return rows, rows


def measure(df: DataFrame) -> tuple[int, int]:
    """Bytes of all values, with a share for each row's overhead, and rows. One aggregate job."""
    widths = [F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) + 16 for c in df.columns]
    row = df.agg(F.sum(reduce(Column.__add__, widths).cast("long")).alias("bytes"), F.count(F.lit(1)).alias("n")).first()
    return row["bytes"] or 0, row["n"]


def fits_broadcast(df: DataFrame) -> bool:
    """Whether all values of ``df`` together stay below the broadcast limit. One aggregate job."""
    return measure(df)[0] <= BROADCAST_MAX_BYTES


def split_hot(df: DataFrame, on: str | list[str], hot: dict[int, int]) -> tuple[DataFrame, DataFrame]:
    """Rows of hot keys, and all other rows."""
    is_hot = key_hash(*_columns(on)).isin(list(hot))
    return df.filter(is_hot), df.filter(~is_hot)


def _distinct_by(df: DataFrame, on: list[str]) -> DataFrame:
    """Distinct rows, partitioned by ``on`` and sorted by it first, as a merge join needs them: one shuffle and one sort.

    No key may be hot.
    """
    equal = Window.partitionBy(*on, *[c for c in df.columns if c not in on]).orderBy(*on)
    numbered = df.repartition(*on).withColumn("copy", F.row_number().over(equal))
    return numbered.filter(F.col("copy") == 1).drop("copy")


def skew_join(
    left: DataFrame,
    right: DataFrame,
    on: str | list[str],
    left_probe: DataFrame | KeySketch | None = None,
    right_probe: DataFrame | KeySketch | None = None,
    copies: bool = False,
    distinct: Collection[str] = (),
) -> DataFrame:
    """Inner equi-join. Rows of a hot key are cut into slices, the other side's rows of that key
    are repeated once per slice; with both sides hot, every pair still meets exactly once.

    Slices are chosen by a hash of the row, so both inputs should be free of duplicate rows; ``copies``
    says that the left one is not, and tells equal rows apart by their partitions. Sides named in ``distinct``
    ("left", "right") lose their copies: without hot keys in one shuffle and one sort with the join.
    A probe is a cheaper place to look for hot keys: the scan below a ``distinct``, or stored sketches.
    Without hot keys this is a plain join, left to adaptive execution.
    """
    on = _columns(on)
    probes = [left if left_probe is None else left_probe, right if right_probe is None else right_probe]
    hot_left, hot_right = hot_keys(probes, on)
    hot = hot_left.keys() | hot_right.keys()
    if not hot:
        left, right = (_distinct_by(df, on) if side in distinct else df for side, df in (("left", left), ("right", right)))
        return left.join(right, on)
    left, right = (df.dropDuplicates() if side in distinct else df for side, df in (("left", left), ("right", right)))
    slices = F.broadcast(
        left.sparkSession.createDataFrame(
            [(h, hot_left.get(h, 1), hot_right.get(h, 1)) for h in sorted(hot)],
            "key_hash long, n_left long, n_right long",
        )
    )

    def sliced(df: DataFrame, own: str, other: str) -> DataFrame:
        apart = [F.spark_partition_id()] if copies and own == "left" else []
        row_hash, one = F.xxhash64(*df.columns, *apart), F.lit(1).cast("long")
        return (
            df.withColumn("key_hash", key_hash(*on))
            .join(slices, "key_hash", "left")
            .withColumn(f"slice_{own}", F.pmod(row_hash, F.coalesce(f"n_{own}", one)))
            .withColumn(f"slice_{other}", F.explode(F.sequence(one - 1, F.coalesce(f"n_{other}", one) - 1)))
            .drop("key_hash", "n_left", "n_right")
        )

    salted = [*on, "slice_left", "slice_right"]
    return sliced(left, "left", "right").join(sliced(right, "right", "left"), salted).drop("slice_left", "slice_right")


def present(left: DataFrame, keys: DataFrame, on: str | list[str]) -> DataFrame:
    """Rows of ``left`` with a match in ``keys``, which must be distinct.

    Catalyst moves semi and anti joins below a preceding ``distinct``, back onto the raw
    copies; inner and outer joins stay where they are written.
    """
    return left.join(keys, on)


def absent(left: DataFrame, keys: DataFrame, on: str | list[str]) -> DataFrame:
    """Rows of ``left`` without a match in ``keys``, which must be distinct; see :func:`present`."""
    flagged = left.join(keys.withColumn("known", F.lit(True)), on, "left")
    return flagged.filter(F.col("known").isNull()).drop("known")


def existence_join(
    left: DataFrame,
    right: DataFrame,
    on: str | list[str],
    how: str,
    left_probe: DataFrame | KeySketch | None = None,
    balanced: bool = False,
    limit: int | None = None,
) -> DataFrame:
    """``left_semi`` or ``left_anti`` join against the keys of ``right``; the columns of ``left`` in their order.

    A key list of checked size is broadcast. Beyond ``limit`` bytes, a Bloom filter of fixed size is broadcast
    first, so that only rows which may be listed are shuffled. Of these, rows of hot keys meet
    the few hot keys of ``right`` in a broadcast, too. ``left_probe`` is where to look for them;
    ``balanced`` says that there are none.
    """
    on = _columns(on)
    keys = right.select(*on)
    size, n_keys = measure(keys)
    if size <= (BROADCAST_MAX_BYTES if limit is None else limit):
        return left.join(F.broadcast(keys), on, how).select(*left.columns)
    keys, blocks = keys.distinct(), n_blocks(n_keys)
    (hot,) = [{}] if balanced else hot_keys([left if left_probe is None else left_probe], on)
    if blocks is None:
        return _shuffled_existence(left, keys, on, how, hot)
    possible, unlisted = split_by_filter(left, on, bloom_filter(keys, on, blocks), blocks)
    listed = _shuffled_existence(possible, keys, on, how, hot)
    return listed if how == "left_semi" else listed.unionByName(unlisted)


def _shuffled_existence(left: DataFrame, keys: DataFrame, on: list[str], how: str, hot: dict[int, int]) -> DataFrame:
    """The join by a shuffle of both sides, but for rows of hot keys; ``keys`` is distinct."""
    shuffled = {"left_semi": present, "left_anti": absent}[how]
    if not hot:
        return shuffled(left, keys, on).select(*left.columns)
    hot_rows, rest = split_hot(left, on, hot)
    hot_side, _ = split_hot(keys, on, hot)
    both = hot_rows.join(F.broadcast(hot_side), on, how).unionByName(shuffled(rest, keys, on))
    return both.select(*left.columns)


def lookup_join(
    facts: DataFrame,
    lookup: DataFrame,
    on: str | list[str],
    distinct: bool = False,
    probe: DataFrame | KeySketch | None = None,
    copies: bool = False,
) -> DataFrame:
    """Inner join with a lookup table: broadcast when its checked size allows, else :func:`skew_join`.

    Columns in both cases: the key, then the other columns of either side. ``distinct`` says
    that copies of a fact don't matter; they are then removed before a shuffle, in which
    they would stay in one slice; ``copies`` that they matter and must be spread, too. ``probe`` is
    where to look for hot keys of the facts.
    """
    if fits_broadcast(lookup):
        return facts.join(F.broadcast(lookup), on)
    left_probe = facts if probe is None else probe
    return skew_join(facts, lookup, on, left_probe=left_probe, copies=copies, distinct=["left"] if distinct else [])
