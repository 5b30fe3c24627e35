"""Triples that were stored together with what later plans need to know about their keys.

While a dump is stored, the keys of each predicate are sketched: which subjects, linked ids and
literal values are frequent, how many rows there are, and how many bytes. The sketches are
mergeable, so those of several predicates are combined when a join is planned, instead of
scanning the joined rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from triplewright.functions.text import iri_id, literal_value
from triplewright.operators.skew import KeySketch, accumulated, combine_sketches, key_hash, merger

# What joins on triples use as keys, by name. Ids are taken of IRIs only.
KEYS: dict[str, Callable[[], Column]] = {
    "sub": lambda: F.col("sub"),
    "id": lambda: F.when(F.startswith("obj", F.lit("<")), iri_id(F.col("obj"))),
    "value": lambda: literal_value(F.col("obj")),
}


@dataclass(frozen=True)
class StoredTriples:
    """Rows (sub, pred, obj), and the sketches of their keys.

    keys:      (pred, key, n, bytes, sketch), one row for each predicate and key of ``KEYS``
    totals:    the rows of each predicate and key, as far as they are known
    whole:     whether ``rows`` are all rows that were sketched
    clustered: of predicates that are laid out by subject, see :mod:`triplewright.sources.clustered`: the rows
               laid out so, and those of hot subjects, if there are any
    """

    rows: DataFrame
    keys: DataFrame
    totals: dict[tuple[str, str], int] | None = None
    whole: bool = True
    clustered: dict[str, tuple[DataFrame, DataFrame | None]] = field(default_factory=dict)

    def restricted_to(self, rows: DataFrame) -> StoredTriples:
        """The same with fewer rows: sketches then tell which keys may be frequent."""
        return replace(self, rows=rows, whole=False, clustered={})

    def sketch(self, key: str, preds: list[str] | None = None) -> KeySketch:
        """The sketches of one key, of some or all predicates."""
        states = self.keys.filter(F.col("key") == key)
        if preds is not None:
            states = states.filter(F.col("pred").isin(*preds))
        total = None
        if self.totals is not None:
            total = sum(n for (pred, name), n in self.totals.items() if name == key and (preds is None or pred in preds))
        return KeySketch(states.select("n", "sketch"), self.whole, total)


Triples = DataFrame | StoredTriples


def rows_of(triples: Triples) -> DataFrame:
    return triples.rows if isinstance(triples, StoredTriples) else triples


def sketch_predicates(triples: DataFrame) -> DataFrame:
    """(pred, key, n, bytes, sketch) of a frame (sub, pred, obj). ``bytes`` are those of subject and object."""
    width = (F.octet_length("sub") + F.octet_length("obj")).cast("long")
    keyed = triples.select("pred", F.coalesce(width, F.lit(0).cast("long")).alias("bytes"), *[key().alias(name) for name, key in KEYS.items()])
    hashed = keyed.select("pred", "bytes", *[F.when(F.col(name).isNotNull(), key_hash(name)).alias(name) for name in KEYS])
    # One group a predicate takes the hashes of all its keys.
    states = hashed.groupBy("pred", merger()).agg(*[state for name in KEYS for state in accumulated(name, f"{name}_")])
    by_key = F.array(*[F.struct(F.lit(name).alias("key"), *[F.col(f"{name}_{part}").alias(part) for part in ("sketch", "n", "bytes")]) for name in KEYS])
    return combine_sketches(states.select("pred", F.inline(by_key)).filter("n > 0"), ["pred", "key"])


def probe(triples: Triples, preds: Iterable[str], key: str, name: str = "sub") -> DataFrame | KeySketch:
    """Where to look for the hot keys of some predicates: their stored sketches, or the rows' keys as column ``name``."""
    preds = list(preds)
    if isinstance(triples, StoredTriples):
        return triples.sketch(key, preds)
    return triples.filter(F.col("pred").isin(*preds)).select(KEYS[key]().alias(name))
