"""SimHash near-duplicates found with pivot distance tables.

A text's fingerprint has 64 bits, each the majority of that bit over the hashes of
its word shingles. Exact copies share a fingerprint, so distances are looked at
between distinct fingerprints only.

For each fingerprint the Hamming distances to two sets of reference fingerprints are
worked out once:

- key references: zero, and three within each group of four bits. The distances to
  the three, less the distance to zero, tell the sixteen contents of the group apart
  (as four coins are told apart by three weighings), so equal coordinates over some
  groups mean equal bits there. The groups form bands; two fingerprints that differ
  in at most ``d`` bits agree in all but ``d`` bands. Every choice of the other
  bands is one key, and only pairs with a common key are looked at.
- filter references: eight fixed random fingerprints. By the triangle inequality a
  pair whose distances to any of them differ by more than ``d`` is discarded. The
  rest is verified by the distance itself.

All tests are part of the join condition, so a discarded pair is never a row. Nothing is
capped: a bucket with many distinct fingerprints is split by adaptive execution.

Defined cases: a text of fewer words than a shingle is one shingle; NULL, empty and
wordless texts have fingerprint 0, which links like any other; repeated rows share
everything; a very long text is hashed whole, block by block; a bit set in exactly half of the
shingles is 0; a NULL doc_id is kept, never names a group, and a group of nothing else
has a NULL component; an empty table gives an empty result.
"""

from __future__ import annotations

import random
from collections.abc import Iterable, Iterator, Sequence
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricehouse.llm.components import components
from pricehouse.llm.rows import keep_least, row_key
from pricehouse.llm.text import pick, slices
from pricehouse.session import materialize

#: Words to a shingle, seed of the shingle hash, greatest distance of a link.
SHINGLE, HASH_SEED, DISTANCE = 3, 42, 3

#: Bands that the sixteen groups of four bits are cut into. With six bands a key has at
#: least 28 bits; tables of over 10**9 distinct texts are better served by eight (40 bits).
BANDS = 6

#: Three subsets of four bits whose overlaps with a set of bits determine the set.
WEIGHINGS = (0b0011, 0b0101, 0b1110)

#: Filter references: fixed random fingerprints.
FILTERS = tuple(random.Random(9).getrandbits(64) for _ in range(8))

#: Shingles turned to bits at once.
_BLOCK = 1 << 15


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """The fingerprint of a text in UTF-8; A-Z are lower-cased, words split at white space."""
    import xxhash

    words = text.lower().split()  # bytes: ASCII letters and the six ASCII white-space bytes only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), "int64", len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(words) - shingle + 1)
    begin, end = starts[:n].tolist(), ends[-n:].tolist()
    votes = np.zeros(64, "int64")
    hashed = xxhash.xxh64_intdigest
    for at in range(0, n, _BLOCK):
        hashes = np.array(
            [hashed(joined[i:j], HASH_SEED) for i, j in zip(begin[at : at + _BLOCK], end[at : at + _BLOCK])], "<u8"
        )
        votes += np.unpackbits(hashes.view("u1").reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype="int64")
    return int.from_bytes(np.packbits(votes * 2 > n, bitorder="little").tobytes(), "little")


def _fingerprinted(
    shingle: int, batches: Iterable[pa.RecordBatch], kept: Sequence[str] = ("doc_id",)
) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole, "text"):
            found = [fingerprint(x or b"", shingle) for x in batch.column("text").to_pylist()]
            signed = np.array(found, "<u8").view("<i8")
            yield pa.RecordBatch.from_arrays([*map(batch.column, kept), pa.array(signed)], [*kept, "fingerprint"])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fingerprint as a signed long) of every row."""
    raw = pick(docs, ["doc_id", "text"]).select(F.col("doc_id").cast("bigint"), F.col("text").cast("binary"))
    return raw.mapInArrow(lambda b: _fingerprinted(shingle, b), "doc_id bigint, fingerprint bigint")


def _signed(x: int) -> Column:
    return F.lit(x - (1 << 64) if x >> 63 else x).cast("bigint")


def _distance_to(reference: int) -> Column:
    return F.bit_count(F.col("fingerprint").bitwiseXOR(_signed(reference)))


def _packed(parts: list[Column], width: int) -> Column:
    """Small numbers side by side in one long."""
    shifted = [F.call_function("shiftleft", p.cast("bigint"), F.lit(width * i)) for i, p in enumerate(parts)]
    return reduce(Column.bitwiseOR, shifted)


def key_coordinates(group: int) -> Column:
    """The three key coordinates of a group of four bits, packed in six bits."""
    zero = _distance_to(0)
    overlaps = []
    for subset in WEIGHINGS:
        weight = subset.bit_count()
        apart = zero + F.lit(weight) - _distance_to(subset << (4 * group))
        overlaps.append(F.call_function("shiftright", apart, F.lit(1)))  # bits in common, 0 to 3
    return _packed(overlaps, 2)


def keyed(distinct: DataFrame, distance: int = DISTANCE, bands: int = BANDS) -> DataFrame:
    """Each fingerprint once for every choice of bands, with its filter coordinates packed."""
    if not distance < bands <= 10:
        raise ValueError("needs more bands than the distance, and ten at most")
    of_band = [[g for g in range(16) if g * bands // 16 == b] for b in range(bands)]
    table = distinct.select(
        "fingerprint",
        _packed([_distance_to(r) for r in FILTERS], 8).alias("filters"),
        *[key_coordinates(g).alias(f"g{g}") for g in range(16)],
    )
    keys = []
    for number, chosen in enumerate(combinations(range(bands), bands - distance)):
        groups = [g for b in chosen for g in of_band[b]]
        words = [_packed([F.col(f"g{g}") for g in groups[i : i + 10]], 6) for i in range(0, len(groups), 10)]
        words = words if len(words) == 2 else [*words, F.lit(0).cast("bigint")]
        keys.append(F.struct(F.lit(number).alias("choice"), words[0].alias("low"), words[1].alias("high")))
    return table.select("fingerprint", "filters", F.explode(F.array(*keys)).alias("k")).select(
        "fingerprint", "filters", "k.choice", "k.low", "k.high"
    )


def links(distinct: DataFrame, distance: int = DISTANCE, bands: int = BANDS) -> DataFrame:
    """Pairs (left, right) of distinct fingerprints that differ in at most ``distance`` bits."""
    table = keyed(distinct, distance, bands)
    left = table.select(*[F.col(c).alias(f"l_{c}") for c in table.columns])
    right = table.select(*[F.col(c).alias(f"r_{c}") for c in table.columns])
    same_key = [F.col(f"l_{c}") == F.col(f"r_{c}") for c in ("choice", "low", "high")]
    near = []
    for i in range(len(FILTERS)):
        a, b = [
            F.call_function("shiftright", F.col(f"{s}_filters"), F.lit(8 * i)).bitwiseAND(F.lit(255)) for s in "lr"
        ]
        near.append(F.abs(a - b) <= distance)
    exact = F.bit_count(F.col("l_fingerprint").bitwiseXOR(F.col("r_fingerprint"))) <= distance
    ordered = F.col("l_fingerprint") < F.col("r_fingerprint")
    joined = left.join(right, reduce(Column.__and__, [*same_key, ordered, *near, exact]))
    return joined.select(F.col("l_fingerprint").alias("left"), F.col("r_fingerprint").alias("right")).distinct()


def near_duplicates(
    docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE, bands: int = BANDS
) -> DataFrame:
    """(doc_id, fingerprint as 16 hex digits, component_id: the least doc_id reachable by links)."""
    prints = materialize(fingerprints(docs, shingle), "fingerprints")
    groups = materialize(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("least")), "fingerprint-groups")
    found = components(links(groups.select("fingerprint"), distance, bands), "left", "right")
    placed = groups.join(found, F.col("fingerprint") == F.col("node"), "left").select(
        "fingerprint", "least", F.coalesce("component", "fingerprint").alias("component")
    )
    leasts = placed.groupBy("component").agg(F.min("least").alias("component_id"))
    named = placed.select("fingerprint", "component").join(leasts, "component").select(
        F.col("fingerprint").alias("print"), "component_id"
    )
    return prints.join(named, F.col("fingerprint") == F.col("print"), "left").select(
        "doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id"
    )


def keep_first(docs: DataFrame, **options) -> DataFrame:
    """One row of each group of near-duplicates: that with the least row key; same columns.

    Rows are told apart by doc_id and all columns, so different texts under one doc_id,
    and rows without a doc_id, are nodes of their own.
    """
    keyed = docs.select(row_key(docs).alias("key"), F.col("doc_id").cast("bigint"), F.col("text").cast("binary"))
    nodes = materialize(keyed.mapInArrow(
        lambda b: _fingerprinted(options.get("shingle", SHINGLE), b, ["key", "doc_id"]),
        "key binary, doc_id bigint, fingerprint bigint",
    ), "row-fingerprints")
    limits = {k: v for k, v in options.items() if k != "shingle"}
    found = components(links(nodes.select("fingerprint").distinct(), **limits), "left", "right")
    placed = nodes.join(found, F.col("fingerprint") == F.col("node"), "left").select(
        "key", "doc_id", F.coalesce("component", "fingerprint").alias("component")
    )
    return keep_least(docs, materialize(placed, "row-groups"))
