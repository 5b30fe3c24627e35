"""Near-duplicates by SetSketch registers.

A document's set is that of its distinct shingles of a number of lower-cased words, four by
default. Each of the ``N_REGISTERS`` registers keeps the minimum of an exponentially distributed hash over the set,
truncated to a step of an exponential scale: registers of a union are the maxima of the
registers, and two sets agree in a register about as often as they agree in shingles.

1. Rows with the same word sequence form a class; everything below works on classes.
2. Bands of ``BAND_REGISTERS`` registers are hashed. Members of a bucket are compared with the
   bucket's smallest member, never with each other: as many pairs as members.
3. A pair's similarity is estimated by likelihood from the registers in which one set, the
   other, or neither is ahead, jointly with both set sizes. Pairs far below the threshold go.
4. The others are confirmed on the full shingle sets; confirmed links form components.
5. In ``TURNS`` turns, members of buckets that still hold several components meet other centres,
   each only those most like it. A large group of near copies that its first centres did not
   join comes together here for the most part, with as many pairs a turn as members.
6. What is left apart is searched by rare shingles. Only pairs that share one, with enough
   shingles left after it, can be similar enough (see ``rare_shingles``), which keeps documents
   with a common passage apart, and most of their registers agree. Those outside the largest
   component with a shingle meet all others with it. There is no cap on buckets, members or partners.

Confirmed links are exact. A link can be missed: two sets of similarity 0.8 share no band with
probability 3e-6, and the estimate, or the count of equal registers in step 6, drops such a
pair with about 1e-5. Only pairs decided on full sets are left out of later searches.

Defined results: null texts and texts without words have an empty set and are linked with
nothing. A null id takes no part in the choice of the smallest id; where a component has
no other id, its id is null. Repeated rows fall into one class. An empty table gives an
empty result. Only the id and text columns are read; other columns may have any names.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from triplewright.llm.batches import Columns, add_columns, cut
from triplewright.llm.components import components
from triplewright.llm.words import mix, powers, utf8, window_hashes, word_hashes
from triplewright.operators.skew import existence_join
from triplewright.session import materialize, run_folder, scratch_path, shuffles_deleted

SHINGLE_WORDS = 4
N_BANDS = 24
BAND_REGISTERS = 4
N_REGISTERS = N_BANDS * BAND_REGISTERS
# Links need 100 * intersection >= THRESHOLD * union.
THRESHOLD = 80
# Pairs estimated below are not confirmed: 4.5 standard errors under the threshold.
ESTIMATE_CUT = 0.62
# Fewest equal registers of a pair that is worth a closer look: 4.9 standard errors under 0.8.
EQUAL_CUT = 58
# Registers' low bytes per 64-bit number; one byte stays free for carries.
PRINT_BYTES = 7
N_PRINTS = -(-N_REGISTERS // PRINT_BYTES)
# Texts that a task holds as Python strings at once.
TEXTS_AT_ONCE = 1000
# Scale of the registers: value k stands for minima around BASE ** -k.
BASE, RATE, TOP = 1.001, 20.0, 2**16 - 1
# Bits of a shingle hash by which frequencies are counted, and tasks that add them up.
FREQUENCY_BITS = 20
MERGERS = 8
# Parts of the members of one bucket centre.
N_PARTS = 64
# Centres that a member of a bucket with several components meets in a turn, and turns before
# rare shingles are searched.
CENTRES = 3
TURNS = 2

_U = np.uint64
_SLOPES = mix(np.arange(1, N_REGISTERS + 1, dtype=_U) * _U(0x9E3779B97F4A7C15)) | _U(1)
_OFFSETS = mix(_SLOPES + _U(12345))


def shingles(hashes: np.ndarray, bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles of ``size`` words of a block of texts, and where each text's begin."""
    n_words = np.diff(bounds)
    counts = np.where(n_words >= size, n_words - size + 1, np.minimum(n_words, 1))
    begins = np.concatenate([[0], np.cumsum(counts)])
    result = np.empty(begins[-1], dtype=_U)
    windows = window_hashes(hashes, size)
    long = np.repeat(n_words >= size, counts)
    text_of = np.repeat(np.arange(len(counts)), counts)
    source = np.arange(len(result)) - begins[text_of] + bounds[text_of]
    result[long] = windows[source[long]]
    for i in np.flatnonzero((n_words > 0) & (n_words < size)):
        result[begins[i]] = window_hashes(hashes[bounds[i] : bounds[i + 1]], int(n_words[i]))[0]
    return result, begins


def sequence_ids(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """128 bits that identify each text's word sequence, for texts with words."""
    n_words = np.diff(bounds)
    full = np.flatnonzero(n_words)
    if not len(full):
        return np.empty((0, 2), dtype=">u8")
    step = powers(int(n_words.max()) + 1)
    place = np.arange(len(hashes)) - np.repeat(bounds[:-1], n_words) + 1
    weights, starts, size = step[place], bounds[full], n_words[full].astype(_U)
    first = mix(np.add.reduceat(hashes * weights, starts) + size)
    second = mix(np.add.reduceat(mix(hashes ^ _U(0xA5A5A5A5A5A5A5A5)) * weights, starts) + size)
    return np.stack([first, second], axis=1).astype(">u8")


def registers(keys: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """One row of registers for each non-empty set of shingle hashes."""
    starts = begins[:-1][np.diff(begins) > 0]
    if not len(starts):
        return np.empty((0, N_REGISTERS), dtype=">u2")
    minima = np.empty((N_REGISTERS, len(starts)), dtype=_U)
    hashed = np.empty_like(keys)
    for i in range(N_REGISTERS):
        np.multiply(keys, _SLOPES[i], out=hashed)
        np.add(hashed, _OFFSETS[i], out=hashed)
        minima[i] = np.minimum.reduceat(hashed, starts)
    uniform = (minima.astype(np.float64) + 0.5) / 2.0**64
    exponential = -np.log1p(-np.minimum(uniform, 1 - 2.0**-53)) / RATE
    steps = np.floor(1 - np.log(exponential) / np.log(BASE))
    return np.clip(steps, 0, TOP).T.astype(">u2")


def prints(sketches: np.ndarray) -> np.ndarray:
    """The low bytes of a set's registers, seven to a number."""
    low = np.zeros((len(sketches), N_PRINTS * PRINT_BYTES), dtype=np.uint8)
    low[:, :N_REGISTERS] = sketches.astype(np.uint16) & 0xFF
    wide = np.zeros((len(sketches), N_PRINTS, 8), dtype=np.uint8)
    wide[:, :, :PRINT_BYTES] = low.reshape(len(sketches), N_PRINTS, PRINT_BYTES)
    return wide.reshape(len(sketches), -1).view("<i8")


def equal_registers(a: str, b: str) -> Column:
    """About how many registers two sets have in common: equal bytes of two columns of prints."""
    sevens, tops = 0x007F7F7F7F7F7F7F, 0x0080808080808080

    def zero_bytes(x: Column) -> Column:
        filled = (x.bitwiseAND(F.lit(sevens)) + F.lit(sevens)).bitwiseOR(x)
        return F.bit_count(F.bitwise_not(filled).bitwiseAND(F.lit(tops)))

    equal = [zero_bytes(F.get(a, i).bitwiseXOR(F.get(b, i))) for i in range(N_PRINTS)]
    return reduce(Column.__add__, equal) - (N_PRINTS * PRINT_BYTES - N_REGISTERS)


def _distinct(keys: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Number of distinct keys of each text."""
    counts = np.diff(begins)
    text_of = np.repeat(np.arange(len(counts), dtype=_U), counts)
    tagged = keys + text_of * _U(0x9E3779B97F4A7C15)
    order = np.argsort(tagged)
    copies = order[1:][tagged[order][1:] == tagged[order][:-1]]
    return counts - np.bincount(text_of[copies].astype(np.int64), minlength=len(counts))


def _sketch(texts: list[str | None], size: int) -> Columns:
    ids: list[bytes | None] = [None] * len(texts)
    sketches: list[bytes | None] = [None] * len(texts)
    low_bytes: list[np.ndarray | None] = [None] * len(texts)
    sizes = np.zeros(len(texts), dtype=np.int64)
    for rows, hashes, bounds in word_hashes([utf8(text) for text in texts], lower=True):
        keys, begins = shingles(hashes, bounds, size)
        sizes[rows.start : rows.stop] = _distinct(keys, begins)
        full = np.flatnonzero(np.diff(bounds)) + rows.start
        found = registers(keys, begins)
        for i, own, sketch, low in zip(full.tolist(), sequence_ids(hashes, bounds), found, prints(found)):
            ids[i], sketches[i], low_bytes[i] = own.tobytes(), sketch.tobytes(), low
    return {"class": ids, "n_shingles": sizes, "registers": sketches, "prints": low_bytes}


def _class_ids(texts: list[str | None]) -> list[bytes | None]:
    ids: list[bytes | None] = [None] * len(texts)
    for rows, hashes, bounds in word_hashes([utf8(text) for text in texts], lower=True):
        full = np.flatnonzero(np.diff(bounds)) + rows.start
        for i, own in zip(full.tolist(), sequence_ids(hashes, bounds)):
            ids[i] = own.tobytes()
    return ids


def with_class(df: DataFrame, text: str = "text", name: str = "class") -> DataFrame:
    """Add 16 bytes that identify the word sequence; null without words."""
    return add_columns(df, [text], f"{name} binary", lambda texts: {name: _class_ids(texts)}, rows_at_once=TEXTS_AT_ONCE)


def sketch(df: DataFrame, text: str = "text", size: int = SHINGLE_WORDS) -> DataFrame:
    """Replace the text by ``class``, ``n_shingles``, ``registers`` (two bytes each) and ``prints``."""
    fields = "class binary, n_shingles long, registers binary, prints array<long>"
    return add_columns(df, [text], fields, lambda texts: _sketch(texts, size), drop=True, rows_at_once=TEXTS_AT_ONCE)


def _bands() -> Column:
    """Hashes of all bands of ``registers``, each with its number."""
    width = 2 * BAND_REGISTERS
    return F.array(
        *[F.xxhash64(F.lit(i), F.substring("registers", i * width + 1, width)) for i in range(N_BANDS)]
    )


def estimate_similarity(ahead: np.ndarray, behind: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Most likely similarity, given in how many registers set a is ahead of b and behind it.

    With relative sizes u and v and similarity J, a is ahead with probability p(u - v J) and
    behind with p(v - u J), where p(x) = -log_BASE(1 - x (BASE - 1) / BASE). The log-likelihood
    is concave in J, so its slope is bisected.
    """
    equal = N_REGISTERS - ahead - behind
    u, v = n_a / (n_a + n_b), n_b / (n_a + n_b)
    c, log_base = (BASE - 1) / BASE, np.log(BASE)
    low, high = np.zeros(len(u)), np.minimum(u / v, v / u)
    tiny = 1e-12
    for _ in range(30):
        middle = (low + high) / 2
        x, y = np.maximum(u - v * middle, tiny), np.maximum(v - u * middle, tiny)
        p_x, p_y = -np.log1p(-c * x) / log_base, -np.log1p(-c * y) / log_base
        slope_x, slope_y = v * c / (log_base * (1 - c * x)), u * c / (log_base * (1 - c * y))
        slope = equal * (slope_x + slope_y) / np.maximum(1 - p_x - p_y, tiny)
        slope -= ahead * slope_x / p_x + behind * slope_y / p_y
        low, high = np.where(slope > 0, middle, low), np.where(slope > 0, high, middle)
    return (low + high) / 2


def _estimates(sketch_a: list[bytes], sketch_b: list[bytes], n_a: list[int], n_b: list[int]) -> Columns:
    a = np.frombuffer(b"".join(sketch_a), dtype=">u2").reshape(-1, N_REGISTERS)
    b = np.frombuffer(b"".join(sketch_b), dtype=">u2").reshape(-1, N_REGISTERS)
    sizes = np.array(n_a, dtype=np.float64), np.array(n_b, dtype=np.float64)
    return {"similarity": estimate_similarity((a > b).sum(axis=1), (a < b).sum(axis=1), *sizes)}


def likely_pairs(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs (a, b) of classes whose estimated similarity isn't far below the threshold."""
    for side in ("a", "b"):
        columns = [F.col("class").alias(side), F.col("registers").alias(f"r_{side}"), F.col("n_shingles").alias(f"n_{side}")]
        pairs = pairs.join(classes.select(*columns), side)
    small = F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * THRESHOLD
    estimated = add_columns(
        pairs.filter(small), ["r_a", "r_b", "n_a", "n_b"], "similarity double", _estimates, drop=True
    )
    return estimated.filter(F.col("similarity") >= ESTIMATE_CUT).select("a", "b")


def _confirm(size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows sorted by (a, part), first the text of a, then those of its partners b."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centre, own = None, np.empty(0, dtype=_U)
        for batch in cut(batches, TEXTS_AT_ONCE):
            a, b, part, texts = (batch.column(name).to_pylist() for name in ("a", "b", "part", "text"))
            linked = []
            for rows, hashes, bounds in word_hashes([utf8(text) for text in texts], lower=True):
                keys, begins = shingles(hashes, bounds, size)
                for i, at in zip(rows, range(len(rows))):
                    found = np.unique(keys[begins[at] : begins[at + 1]])
                    if b[i] is None:
                        centre, own = (a[i], part[i]), found
                        continue
                    if centre != (a[i], part[i]):
                        raise ValueError("a text without its centre")
                    common = len(np.intersect1d(own, found, assume_unique=True))
                    if 100 * common >= THRESHOLD * (len(own) + len(found) - common):
                        linked.append(i)
            yield pa.RecordBatch.from_arrays(
                [pa.array([a[i] for i in linked], pa.binary()), pa.array([b[i] for i in linked], pa.binary())], names=["a", "b"]
            )

    return run


def confirmed(pairs: DataFrame, texts: DataFrame, size: int) -> DataFrame:
    """The pairs (a, b) that are similar by their full shingle sets.

    The partners of a centre are dealt over parts; the centre's text is sent once to each.
    """
    dealt = pairs.withColumn("part", F.pmod(F.xxhash64("b"), F.lit(N_PARTS)))
    centres = dealt.select("a", "part").distinct().withColumn("b", F.lit(None).cast("binary"))
    rows = dealt.join(texts.withColumnRenamed("class", "b"), "b").select("a", "part", "b", "text")
    rows = rows.union(centres.join(texts.withColumnRenamed("class", "a"), "a").select("a", "part", "b", "text"))
    sorted_rows = rows.repartition("a", "part").sortWithinPartitions("a", "part", F.col("b").asc_nulls_first())
    return sorted_rows.mapInArrow(_confirm(size), "a binary, b binary")


def _text_shingles(texts: list[str], size: int) -> Iterator[tuple[int, np.ndarray]]:
    """Each text's number and its distinct shingle hashes."""
    for rows, hashes, bounds in word_hashes([utf8(text) for text in texts], lower=True):
        keys, begins = shingles(hashes, bounds, size)
        for at, i in enumerate(rows):
            yield i, np.unique(keys[begins[at] : begins[at + 1]])


def _cell(keys: np.ndarray) -> np.ndarray:
    return (keys >> _U(64 - FREQUENCY_BITS)).astype(np.int64)


def shingle_frequencies(texts: DataFrame, size: int) -> np.ndarray:
    """About how many texts have a shingle, by the top bits of its hash: a fixed number of sums.

    Every task adds up its texts; a few tasks add up the tasks.
    """

    def packed(counts: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([zlib.compress(counts.tobytes(), 1)], pa.binary())], names=["counts"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << FREQUENCY_BITS, dtype=np.int64)
        for batch in cut(batches, TEXTS_AT_ONCE):
            for _, keys in _text_shingles(batch.column("text").to_pylist(), size):
                counts[_cell(keys)] += 1
        if counts.any():
            yield packed(counts)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << FREQUENCY_BITS, dtype=np.int64)
        for batch in batches:
            for own in batch.column("counts").to_pylist():
                counts += np.frombuffer(zlib.decompress(own), dtype=np.int64)
        if counts.any():
            yield packed(counts)

    counted = texts.select("text").mapInArrow(count, "counts binary")
    rows = counted.repartition(MERGERS).mapInArrow(add, "counts binary").collect()
    total = np.zeros(1 << FREQUENCY_BITS, dtype=np.int64)
    for row in rows:
        total += np.frombuffer(zlib.decompress(row["counts"]), dtype=np.int64)
    return total.astype(np.int32)


def rare_shingles(texts: DataFrame, frequencies: np.ndarray, size: int) -> DataFrame:
    """Add ``band``, one row per rare shingle of a text, and ``place``, its place from 0; drop the text.

    In one order of all shingles, rarest first, two sets of similarity t or more share one of
    the first n - ceil(t n) + 1 shingles of each: a set of n that lacks them all has fewer
    than t n left to share. A text with a passage of others but much of its own thus has
    rare shingles of its own only.
    """

    def first(values: list[str]) -> Columns:
        found: list[np.ndarray | None] = [None] * len(values)
        for i, keys in _text_shingles(values, size):
            order = np.lexsort((keys, frequencies[_cell(keys)]))
            n = len(keys) - -(-THRESHOLD * len(keys) // 100) + 1
            found[i] = keys[order[:n]].view(np.int64)
        return {"rare": found}

    found = add_columns(texts, ["text"], "rare array<long>", first, drop=True, rows_at_once=TEXTS_AT_ONCE)
    return found.select("class", "n_shingles", "component", "prints", F.posexplode("rare").alias("place", "band"))


def texts_of(source: DataFrame, members: DataFrame) -> DataFrame:
    """(class, text): a text of each class among the members.

    Only texts that pass a Bloom filter of the members' classes are shuffled, as those of all others are most of the input.
    """
    return of_members(with_class(source).select("class", "text"), members).dropDuplicates(["class"])


def of_members(rows: DataFrame, members: DataFrame) -> DataFrame:
    """The rows whose class is among the members. Only those that pass a Bloom filter of their classes are shuffled."""
    return existence_join(rows, members.select("class").distinct(), "class", "left_semi", balanced=True, limit=0)


def bucket_members(classes: DataFrame) -> DataFrame:
    """(band, class, n_shingles, centre): the classes of each bucket that has several, and its smallest.

    Most bands belong to a single class. Bare bands are counted first; of the rows with their
    classes only those that pass a Bloom filter of the shared bands are shuffled.
    """
    bands = classes.select("class", "n_shingles", F.explode(_bands()).alias("band"))
    shared = materialize(bands.groupBy("band").agg(F.count("*").alias("n")).filter("n > 1").select("band"), "shared_bands")
    rows = existence_join(bands, shared, "band", "left_semi", balanced=True, limit=0)
    buckets = rows.groupBy("band").agg(F.min("class").alias("centre"), F.max("class").alias("last"))
    return rows.join(buckets.filter("centre <> last").drop("last"), "band")


def _several_components(rows: DataFrame) -> DataFrame:
    """Bands whose rows have more than one component."""
    ends = rows.groupBy("band").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    return ends.filter("low <> high").select("band")


def with_component(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Members with their present components; a class without links is one of its own."""
    named = labels.withColumnRenamed("node", "class")
    return members.drop("component").join(named, "class", "left").withColumn("component", F.coalesce("component", "class"))


def mixed_members(members: DataFrame, labels: DataFrame) -> DataFrame:
    """The members of buckets that hold several components, with these."""
    labelled = with_component(members, labels)
    return labelled.join(_several_components(labelled), "band")


def joined_components(labels: DataFrame, links: DataFrame) -> DataFrame:
    """The components (node, component) after new links, which are followed between components only."""
    ends = links
    for side in ("a", "b"):
        own = labels.select(F.col("node").alias(side), F.col("component").alias(f"of_{side}"))
        ends = ends.join(own, side, "left").withColumn(f"of_{side}", F.coalesce(f"of_{side}", side))
    merged = materialize(components(ends.select(F.col("of_a").alias("a"), F.col("of_b").alias("b"))), "merged")
    to = merged.select(F.col("node").alias("component"), F.col("component").alias("now"))
    known = labels.join(to, "component", "left").select("node", F.coalesce("now", "component").alias("component"))
    alone = merged.join(labels.select("node"), "node", "left_anti").select("node", "component")
    return materialize(known.union(alone).distinct(), "labels")


def centre_pairs(mixed: DataFrame, classes: DataFrame, turn: int) -> DataFrame:
    """Pairs (a, b) of each member outside its bucket's largest component with its best centres.

    Each bucket has two centres in a turn, drawn by hash: one of its largest component, one of
    all others. Of the centres of all its buckets, a member meets the ``CENTRES`` that have most
    registers in common with it: as many pairs as members, whatever the size of a group.
    """
    drawn = F.struct(F.xxhash64("class", F.lit(turn)).alias("order"), F.col("class").alias("centre"))
    of_component = mixed.groupBy("band", "component").agg(F.count("*").alias("n"), F.min(drawn).alias("drawn"))
    largest = of_component.groupBy("band").agg(F.max(F.struct("n", "component", "drawn")).alias("top"))
    largest = largest.select("band", F.col("top.component").alias("largest"), F.col("top.drawn.centre").alias("inside"))
    outside = of_component.join(largest, "band").filter("component <> largest")
    centres = outside.groupBy("band").agg(F.min("drawn")["centre"].alias("outside"), F.first("largest").alias("largest"), F.first("inside").alias("inside"))
    met = (
        mixed.join(centres, "band")
        .filter("component <> largest")
        .select(F.col("class").alias("x"), F.explode(F.array("inside", "outside")).alias("centre"))
        .filter("x <> centre")
        .distinct()
    )
    for side in ("x", "centre"):
        met = met.join(classes.select(F.col("class").alias(side), F.col("prints").alias(f"prints_{side}")), side)
    best = Window.partitionBy("x").orderBy(F.col("equal").desc(), "centre")
    ranked = met.select("x", "centre", equal_registers("prints_x", "prints_centre").alias("equal")).withColumn("place", F.row_number().over(best))
    return ranked.filter(F.col("place") <= CENTRES).select(F.least("x", "centre").alias("a"), F.greatest("x", "centre").alias("b")).distinct()


def remaining_pairs(mixed: DataFrame, texts: DataFrame, classes: DataFrame, size: int) -> DataFrame:
    """Pairs of different components that share a rare shingle and enough registers, among the
    members of buckets that hold several components; at least one is outside the largest
    component with that shingle."""
    rows = materialize(mixed.select("class", "n_shingles", "component").distinct().join(texts, "class").join(classes.select("class", "prints"), "class"), "mixed_texts")
    if rows.isEmpty():
        return rows.select(F.col("class").alias("a"), F.col("class").alias("b"))
    rare = materialize(rare_shingles(rows, shingle_frequencies(rows, size), size), "rare_shingles")
    # Shingles of several components, and the largest of these, in one table: the rows are shuffled once, with their join.
    largest = (
        rare.groupBy("band", "component")
        .agg(F.count("*").alias("n"))
        .groupBy("band")
        .agg(F.max(F.struct("n", "component"))["component"].alias("largest"), F.count("*").alias("components"))
        .filter("components > 1")
        .drop("components")
    )
    shared = rare.join(largest, "band")
    outside = shared.filter("component <> largest").select(
        "band",
        F.col("class").alias("x"),
        F.col("n_shingles").alias("n_x"),
        F.col("component").alias("component_x"),
        F.col("place").alias("place_x"),
        F.col("prints").alias("prints_x"),
    )
    similar_size = F.least("n_x", "n_shingles") * 100 >= F.greatest("n_x", "n_shingles") * THRESHOLD
    # If this is the first shingle that two sets share, in the order of both, they share no more
    # than what is left of either from here on.
    left = F.least(F.col("n_x") - F.col("place_x"), F.col("n_shingles") - F.col("place"))
    enough = left * (100 + THRESHOLD) >= (F.col("n_x") + F.col("n_shingles")) * THRESHOLD
    # A pair of two outside members is found from both; it is kept once.
    once = (F.col("component") == F.col("largest")) | (F.col("x") < F.col("class"))
    return (
        outside.join(shared, "band")
        .filter((F.col("component") != F.col("component_x")) & similar_size & enough & once)
        .filter(equal_registers("prints", "prints_x") >= EQUAL_CUT)
        .select(F.least("x", "class").alias("a"), F.greatest("x", "class").alias("b"))
        .distinct()
    )


def linked_classes(source: DataFrame, classes: DataFrame, size: int) -> DataFrame:
    """(node, component) of all classes with a link, found in steps 2 to 6."""
    members = materialize(bucket_members(classes), "buckets")
    texts = materialize(texts_of(source, members), "texts")
    # All pairs are among these members: the registers of other classes are not shuffled again.
    classes_met = materialize(of_members(classes, members), "classes")
    to_centres = materialize(
        members.filter("class <> centre").select(F.col("centre").alias("a"), F.col("class").alias("b")).distinct(), "pairs"
    )
    tried = materialize(likely_pairs(to_centres, classes_met), "likely")
    labels = materialize(components(confirmed(tried, texts, size)), "labels")
    # Only pairs that were decided on full sets are left out of later searches.
    decided, mixed = tried, materialize(mixed_members(members, labels), "mixed")
    # From here on all pairs are among these members, as a rule few.
    classes_left = materialize(of_members(classes_met, mixed), "classes")
    texts_left = materialize(of_members(texts, mixed), "texts")
    for turn in range(TURNS):
        pairs = centre_pairs(mixed, classes_left, turn).join(decided, ["a", "b"], "left_anti")
        tried = materialize(likely_pairs(pairs, classes_left), "likely")
        links = materialize(confirmed(tried, texts_left, size), "links")
        decided = decided.union(tried)
        if links.isEmpty():
            break
        labels = joined_components(labels, links)
        mixed = materialize(mixed_members(mixed, labels), "mixed")
    others = remaining_pairs(mixed, texts_left, classes_left, size).join(decided, ["a", "b"], "left_anti")
    links = materialize(confirmed(likely_pairs(others, classes_left), texts_left, size), "links")
    return labels if links.isEmpty() else joined_components(labels, links)


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", size: int = SHINGLE_WORDS) -> DataFrame:
    """Per row, for shingles of ``size`` words: ``key``, n_shingles, ``class`` (null for an empty set), component_id (smallest
    key of its component) and ``component`` (the component's smallest class)."""
    source = df.select(F.col(key).alias("key"), F.col(text).alias("text"))
    rows = materialize(sketch(source, size=size), "sketches")
    classes = materialize(
        rows.filter("n_shingles > 0")
        .groupBy("class")
        .agg(F.min("key").alias("key"), *[F.first(name).alias(name) for name in ("n_shingles", "registers", "prints")]),
        "classes",
    )
    # The result reads sketches, classes and labels; the files of the search go with its end.
    spark = df.sparkSession
    to = scratch_path(spark, "labels")
    with run_folder(spark), shuffles_deleted(spark):
        labels = materialize(linked_classes(source, classes, size), "labels", to)
    named = (
        classes.select("class", "key")
        .join(labels.withColumnRenamed("node", "class"), "class", "left")
        .withColumn("component", F.coalesce("component", "class"))
    )
    smallest = named.groupBy("component").agg(F.min("key").alias("component_id"))
    of_class = named.join(smallest, "component").select("class", "component", "component_id")
    full = rows.filter("n_shingles > 0").select("key", "class", "n_shingles").join(of_class, "class")
    empty = rows.filter("n_shingles = 0").select(
        "class", "key", "n_shingles", F.lit(None).cast("binary").alias("component"), F.col("key").alias("component_id")
    )
    return full.unionByName(empty).withColumnRenamed("key", key)


def keep_one(df: DataFrame, key: str = "doc_id", text: str = "text", size: int = SHINGLE_WORDS) -> DataFrame:
    """One row of each component, that with the smallest key (null only if there is no other);
    all rows without words stay. The columns of ``df`` are returned unchanged.
    """
    found = near_duplicates(df, key, text, size).filter("component IS NOT NULL")
    chosen = (
        found.groupBy("component")
        .agg(F.min(F.struct(F.col(key).isNull().alias("unknown"), F.col(key).alias("key"), "class")).alias("row"))
        .select("row.key", "row.class")
    )
    chosen = materialize(chosen.select(F.col("class").alias("__class"), F.col("key").alias("__key")), "kept")
    rows = with_class(df, text, "__class")
    same = rows[key].eqNullSafe(chosen["__key"])
    kept = rows.join(chosen, "__class").filter(same).dropDuplicates(["__class"])
    without_words = rows.filter("__class IS NULL")
    return kept.select(*df.columns).union(without_words.select(*df.columns))
