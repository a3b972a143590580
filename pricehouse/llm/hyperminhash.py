"""Near-duplicates by Jaccard similarity of word shingles, found with HyperMinHash sketches.

A text is the set of its distinct shingles, known by 64 bits of hash. Equal sets are one
node, so copies cost nothing further. A node's sketch has 256 registers: the leading
bits of a hash choose a bucket, and the least of the rest is stored as its number of
leading zeros and ten bits of mantissa. A bucket without a shingle takes the register of
the first filled one in a fixed order of its own, so short texts keep full sketches.

1. Bands of five registers are the join keys: a pair of the least similarity shares none
   of the 40 with a probability of 6e-11.
2. A band's bucket has one centre, the node that shares most buckets. Each node is compared
   with the likeliest of its centres: the similarity is estimated from the registers, corrected for
   the chance that different shingles leave equal registers, and what is not far below
   the limit (``WIDTH`` standard errors) is verified on the full sets. So a large group of near
   copies is mostly one component before any two of its members are compared.
3. Where a bucket still holds several components, its nodes are known by what tells them from
   its centre. Two sets can only be linked if they share enough of that: with the rarest
   of it first, a short prefix of one holds a token of a prefix of the other. Only such
   pairs across components are estimated and verified, so copies with edits of their own never
   meet. What tells a node from its centre also says exactly whether those two are linked.

Nothing is capped. A link can be missed by chance alone: by step 1 as said, and by an estimate, in
the normal approximation, in fewer than one of 100,000 pairs exactly at the limit, and fewer above it.

Defined cases: a text with fewer words than a shingle is one shingle; NULL, empty and
wordless texts have no shingles and are linked with nothing; repeated rows share
everything; rows with one doc_id and different texts are nodes of their own; a NULL
doc_id is never kept and never names a component, so a component of nothing else has a NULL one;
very long texts are tokenized whole, in one task with eight bytes a word; ties between centres go
to the least digest of a set; an empty table gives an empty result; only doc_id and text are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricehouse.llm.components import components
from pricehouse.llm.substring_dedup import hash_words
from pricehouse.llm.text import pick, slices
from pricehouse.session import materialize

#: Words to a shingle; a link has 100 * common >= LEAST * all shingles of both.
SHINGLE, LEAST = 3, 85

#: Registers of a sketch, mantissa bits of a register, registers of a band and bands.
REGISTERS, MANTISSA, ROWS, BANDS = 256, 10, 5, 40

#: Standard errors below the limit at which an estimate still goes to verification.
WIDTH = 4.5

#: Bytes of a shingle's hash that a verified set keeps.
KEPT_BYTES = 6

_FACTORS = np.random.default_rng(11).integers(1 << 62, 1 << 63, 64, dtype="u8") | np.uint64(1)
#: For each bucket the order in which it asks the others for a register.
_ORDER = np.argsort(np.random.default_rng(12).random((REGISTERS, REGISTERS)), axis=1).astype("u1")
_EDGES = np.arange(REGISTERS, dtype="u8") << np.uint64(56)


def _mixed(x: np.ndarray) -> np.ndarray:
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def shingles(text: bytes, width: int = SHINGLE) -> np.ndarray:
    """The distinct hashed shingles of a text in UTF-8, sorted; none without words."""
    words = hash_words(text.lower().split())
    if not len(words):
        return words
    width = min(width, len(words))
    n = len(words) - width + 1
    summed = np.full(n, width, "u8")
    for k in range(width):
        summed += words[k : k + n] * _FACTORS[k]
    return np.unique(_mixed(summed))


def sketch(found: np.ndarray) -> np.ndarray:
    """The registers of a sorted, non-empty set."""
    first = np.searchsorted(found, _EDGES)
    end = np.append(first[1:], len(found))
    filled = first < end
    least = (found[np.minimum(first, len(found) - 1)] << np.uint64(8)) >> np.uint64(11)  # 53 bits: exact as doubles
    part, exponent = np.frexp(least.astype("f8"))
    zeros = np.where(least == 0, 53, 53 - exponent)
    registers = (zeros << MANTISSA) | (part * (2 << MANTISSA)).astype("i8") & ((1 << MANTISSA) - 1)
    if not filled.all():
        order = _ORDER[~filled]
        registers[~filled] = registers[order[np.arange(len(order)), filled[order].argmax(1)]]
    return registers.astype("<u2")


def band_keys(sketches: np.ndarray) -> np.ndarray:
    """A key for each band of each sketch (a row of registers)."""
    used = sketches[:, : ROWS * BANDS].reshape(-1, BANDS, ROWS).astype("u8")
    keys = np.broadcast_to(np.arange(BANDS, dtype="u8") * _FACTORS[8], used.shape[:2]).copy()
    for k in range(ROWS):
        keys = _mixed(keys + (used[:, :, k] + np.uint64(1)) * _FACTORS[9 + k])
    return keys.view("i8")


def _listed(matrix: np.ndarray) -> pa.ListArray:
    step, width = matrix.shape if matrix.size else (len(matrix), 0)
    return pa.ListArray.from_arrays(pa.array(np.arange(step + 1, dtype="i4") * width), pa.array(matrix.reshape(-1)))


_NODES = "doc_id bigint, text_md5 binary, n int, set_id binary, registers binary, keys array<bigint>"


def _sketched(shingle: int, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole, "text"):
            sets = [shingles(x or b"", shingle) for x in batch.column("text").to_pylist()]
            some = [i for i, s in enumerate(sets) if len(s)]
            at = np.full(len(sets), -1)
            at[some] = np.arange(len(some))
            regs = np.array([sketch(sets[i]) for i in some], "<u2").reshape(-1, REGISTERS)
            keys = _listed(band_keys(regs))
            place = pa.array(at, mask=at < 0)
            ids = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), batch.column("text_md5"), pa.array([len(s) for s in sets], pa.int32()),
                    pa.array(ids, pa.binary()), pa.array([r.tobytes() for r in regs], pa.binary()).take(place),
                    keys.take(place),
                ],
                ["doc_id", "text_md5", "n", "set_id", "registers", "keys"],
            )


def _sets(shingle: int, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole, "text"):
            sets = [shingles(x or b"", shingle) for x in batch.column("text").to_pylist()]
            ids = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
            kept = [np.ascontiguousarray(s.view("u1").reshape(-1, 8)[:, 8 - KEPT_BYTES :]).tobytes() for s in sets]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.binary()), pa.array(kept, pa.binary())], ["id", "tokens"])


def _unpacked(kept: bytes) -> np.ndarray:
    wide = np.zeros((len(kept) // KEPT_BYTES, 8), "u1")
    wide[:, 8 - KEPT_BYTES :] = np.frombuffer(kept, "u1").reshape(-1, KEPT_BYTES)
    return wide.view("<u8").reshape(-1)


def common(a: bytes, b: bytes) -> int:
    """Shingles that two kept sets have in common."""
    both = np.concatenate([_unpacked(a), _unpacked(b)])
    both.sort(kind="stable")
    return int(np.count_nonzero(both[1:] == both[:-1]))


def chance(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Probability that the registers of two unlike sets of n and m shingles are equal."""
    zeros = np.arange(40)[:, None]

    def at(size):
        load = np.maximum(size, 1) / REGISTERS
        return np.exp(-load * 2.0 ** -(zeros + 1)) - np.exp(-load * 2.0**-zeros)

    return (at(n) * at(m)).sum(0) / (1 << MANTISSA)


def estimate(a: np.ndarray, b: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Jaccard similarities of pairs of sketches (rows), corrected for collisions."""
    by_chance = chance(n, m)
    return ((a == b).mean(1) - by_chance) / (1 - by_chance)


def bar(n: np.ndarray, m: np.ndarray, least: int) -> np.ndarray:
    """The estimate that a pair needs: sketches of short texts hold fewer registers of their own."""
    own = np.minimum(REGISTERS, REGISTERS * -np.expm1(-np.minimum(n, m) / REGISTERS) + 1)
    return least / 100 - WIDTH * np.sqrt(least / 100 * (1 - least / 100) * (1 / own + 1 / REGISTERS * (own < REGISTERS)))


_PAIRS = "a binary, b binary, score double"


def _estimated(least: int, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        regs = [
            np.frombuffer(b"".join(batch.column(c).to_pylist()), "<u2").reshape(-1, REGISTERS)
            for c in ("a_registers", "b_registers")
        ]
        sizes = [batch.column(c).to_numpy().astype("f8") for c in ("a_n", "b_n")]
        score = estimate(*regs, *sizes)
        kept = pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(score)], ["a", "b", "score"])
        yield kept.filter(pa.array(score >= bar(*sizes, least)))


def _verified(least: int, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        near = []
        for a, b in zip(batch.column("a_tokens").to_pylist(), batch.column("b_tokens").to_pylist()):
            shared = common(a, b)
            near.append(100 * shared >= least * ((len(a) + len(b)) // KEPT_BYTES - shared))
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(near, pa.bool_()))


def _ends(pairs: DataFrame, table: DataFrame, columns: list[str]) -> DataFrame:
    """Columns of both ends of pairs (a, b), named a_* and b_*."""
    for side in ("a", "b"):
        end = table.select(F.col("id").alias("end"), *[F.col(c).alias(f"{side}_{c}") for c in columns])
        pairs = pairs.join(end, F.col(side) == F.col("end")).drop("end")
    return pairs


def _similar_sizes(least: int, a: str, b: str) -> Column:
    n, m = F.col(a).cast("bigint"), F.col(b).cast("bigint")
    return 100 * F.least(n, m) >= least * F.greatest(n, m)


def _differences(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b, sizes of both, tokens that only one of them has)."""
    for batch in batches:
        rows = []
        for a, b in zip(batch.column("a_tokens").to_pylist(), batch.column("b_tokens").to_pylist()):
            one, other = _unpacked(a), _unpacked(b)
            rows.append((len(one), len(other), np.setxor1d(one, other, assume_unique=True).view("i8").tolist()))
        kinds = (pa.int32(), pa.int32(), pa.list_(pa.int64()))
        columns = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), *columns], ["a", "b", "a_n", "b_n", "apart"])


_APART = "a binary, b binary, a_n int, b_n int, apart array<bigint>"


class _Corpus:
    """The sketched sets of a table of documents, and the texts they came from."""

    def __init__(self, docs: DataFrame, shingle: int, least: int):
        named = pick(docs, ["doc_id", "text"]).select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("binary").alias("text"))
        self.keyed = named.withColumn("text_md5", F.unhex(F.md5("text")))
        self.shingle, self.least = shingle, least
        self.nodes = materialize(self.keyed.mapInArrow(lambda b: _sketched(shingle, b), _NODES), "hyperminhash-nodes")
        once = self.nodes.filter("n > 0").groupBy(F.col("set_id").alias("id")).agg(
            F.min("doc_id").alias("least_id"), F.first("n").alias("n"),
            F.first(F.struct("doc_id", "text_md5", "registers", "keys")).alias("one"),
        )
        self.sets = materialize(once.select("id", "least_id", "n", "one.*"), "hyperminhash-sets")

    def fetch(self, members: DataFrame) -> None:
        """Writes the full sets of all nodes that share a bucket."""
        wanted = self.sets.join(members.select(F.col("id").alias("end")).distinct(), F.col("id") == F.col("end"), "left_semi").select(
            F.coalesce("doc_id", F.lit(0)).alias("of_row"), F.col("text_md5").alias("of_text")
        )
        rows = self.keyed.select(F.coalesce("doc_id", F.lit(0)).alias("row"), "text_md5", "text")
        texts = rows.join(wanted, (F.col("text_md5") == F.col("of_text")) & (F.col("row") == F.col("of_row")), "left_semi")
        shingle = self.shingle
        # The join has dealt the rows by these columns; repeated rows are one.
        self.tokens = materialize(
            texts.dropDuplicates(["row", "text_md5"]).mapInArrow(lambda b: _sets(shingle, b), "id binary, tokens binary"),
            "hyperminhash-tokens",
        )

    def links(self, pairs: DataFrame) -> DataFrame:
        """Those pairs (a, b) that are links, by their full sets."""
        least = self.least
        near = _ends(pairs.select("a", "b"), self.tokens, ["tokens"]).mapInArrow(lambda b: _verified(least, b), "a binary, b binary")
        return materialize(near, "hyperminhash-links")

    def likely(self, pairs: DataFrame) -> DataFrame:
        """Pairs (a, b) whose estimate reaches the bar, with it as ``score``."""
        least = self.least
        return _ends(pairs, self.sets, ["registers", "n"]).mapInArrow(lambda b: _estimated(least, b), _PAIRS)

    def members(self) -> DataFrame:
        """(key, id, n, centre): the nodes of every band key that several have, with the bucket's centre."""
        keys = self.sets.select(F.explode("keys").alias("key"), "id", "n")
        counts = keys.groupBy(F.col("key").alias("of_key")).agg(F.count("*").alias("rows")).filter("rows > 1")
        shared = materialize(
            keys.join(counts, F.col("key") == F.col("of_key")).select("key", "id", "n", "rows"), "hyperminhash-buckets"
        )
        weight = shared.groupBy(F.col("id").alias("of_id")).agg(F.sum("rows").alias("weight"))
        weighed = shared.join(weight, F.col("id") == F.col("of_id"))
        centres = weighed.groupBy(F.col("key").alias("of_key")).agg(F.max(F.struct("weight", "id")).alias("centre"))
        joined = shared.join(centres, F.col("key") == F.col("of_key"))
        return materialize(joined.select("key", "id", "n", F.col("centre.id").alias("centre")), "hyperminhash-members")

    def to_centres(self, members: DataFrame) -> DataFrame:
        """Each node with the likeliest of its buckets' centres."""
        pairs = members.filter("id <> centre").select(F.col("centre").alias("a"), F.col("id").alias("b")).distinct()
        best = self.likely(pairs).groupBy("b").agg(F.max(F.struct("score", "a")).alias("best"))
        return best.select(F.col("best.a").alias("a"), "b")

    def across(self, members: DataFrame, placed: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Links with centres, and likely pairs, of buckets that hold several components.

        With ``d`` the number of tokens that tell a node from its centre and ``r`` the share of
        both sizes that linked sets may differ in, two nodes with ``d1 >= d2`` share at least
        ``(d1 + d2 - r * (n1 + n2)) / 2`` of those tokens. The bounds of ``t`` below are the least of
        that over all partners a node can have.
        """
        share = (100 - self.least) / (100 + self.least)
        parts = members.select("key", "id", "centre").join(placed, F.col("id") == F.col("node"), "left").select(
            "key", "id", "centre", F.coalesce("component", "id").alias("part")
        )
        several = parts.groupBy(F.col("key").alias("of_key")).agg(F.min("part").alias("p"), F.max("part").alias("q")).filter("p <> q")
        opened = parts.join(several, F.col("key") == F.col("of_key"), "left_semi").filter("id <> centre")
        opened = materialize(opened.select(F.col("centre").alias("a"), F.col("id").alias("b"), "part").distinct(), "hyperminhash-open")
        apart = _ends(opened.select("a", "b"), self.tokens, ["tokens"]).mapInArrow(_differences, _APART)
        apart = materialize(apart.withColumn("d", F.size("apart")), "hyperminhash-apart")
        linked = F.col("d") <= share * (F.col("a_n") + F.col("b_n")) + 1e-6
        stars = materialize(apart.filter(linked).select("a", "b"), "hyperminhash-stars")

        exploded = apart.select("a", "b", F.explode("apart").alias("token"))
        often = exploded.groupBy(F.col("a").alias("of_a"), F.col("token").alias("of_token")).agg(F.count("*").alias("times"))
        shared = exploded.join(often.filter("times > 1"), (F.col("a") == F.col("of_a")) & (F.col("token") == F.col("of_token")))
        # Tokens of one node only come first in the order; they meet nobody, so their number is enough.
        listed = shared.groupBy(F.col("a").alias("of_a"), F.col("b").alias("of_b")).agg(
            F.array_sort(F.collect_list(F.struct("times", "token"))).alias("common")
        )
        most = F.floor(share * (F.col("b_n") * (1 + 100 / self.least)) + 1e-6)
        as_larger = F.greatest(F.lit(1), F.col("d") - most)
        as_smaller = F.greatest(F.lit(1), F.when(
            linked, F.floor((F.col("d") + share * (F.col("a_n") - F.col("b_n"))) / 2 - 1e-6) + 1
        ).otherwise(F.ceil(F.col("d") - most / 2)))
        alone = F.col("d") - F.size("common")
        prefixes = apart.join(listed, (F.col("a") == F.col("of_a")) & (F.col("b") == F.col("of_b"))).select(
            "a", "b", "b_n", "d", "common",
            *[F.greatest(F.lit(0), F.col("d") - t + 1 - alone).cast("int").alias(name) for t, name in ((as_larger, "long"), (as_smaller, "short"))],
        )
        prefixes = prefixes.join(opened.select(F.col("a").alias("of_a"), F.col("b").alias("of_b"), "part"), (F.col("a") == F.col("of_a")) & (F.col("b") == F.col("of_b")))
        prefixes = materialize(prefixes.drop("of_a", "of_b"), "hyperminhash-prefixes")
        sides = [
            prefixes.filter(F.col(length) > 0).select(
                *[F.col(c).alias(f"{side}_{c}") for c in ("a", "b", "b_n", "d", "part")],
                F.explode(F.slice("common", F.lit(1), F.col(length))).alias(f"{side}_t"),
            ).withColumn(f"{side}_token", F.col(f"{side}_t.token")).drop(f"{side}_t")
            for side, length in (("l", "long"), ("s", "short"))
        ]
        met = (
            (F.col("l_a") == F.col("s_a")) & (F.col("l_token") == F.col("s_token")) & (F.col("l_part") != F.col("s_part"))
            & ((F.col("l_d") > F.col("s_d")) | (F.col("l_d") == F.col("s_d")) & (F.col("l_b") > F.col("s_b")))
            & (F.col("l_d") - F.col("s_d") <= share * (F.col("l_b_n") + F.col("s_b_n")) + 1e-6)
            & _similar_sizes(self.least, "l_b_n", "s_b_n")
        )
        pairs = sides[0].join(sides[1], met).select(F.col("l_b").alias("a"), F.col("s_b").alias("b")).distinct()
        return stars, self.likely(pairs)


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, least: int = LEAST) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row.

    component_id is the least doc_id that links reach; kept holds for the rows that name one.
    """
    corpus = _Corpus(docs, shingle, least)
    members = corpus.members()
    corpus.fetch(members)
    first = corpus.links(corpus.to_centres(members))
    stars, others = corpus.across(members, components(first, "a", "b"))
    placed = components(first.unionByName(stars).unionByName(corpus.links(others)), "a", "b")
    named = corpus.sets.select("id", "least_id").join(placed, F.col("id") == F.col("node"), "left").select(
        "id", "least_id", F.coalesce("component", "id").alias("component")
    )
    leasts = named.groupBy(F.col("component").alias("of_component")).agg(F.min("least_id").alias("component_id"))
    names = named.join(leasts, F.col("component") == F.col("of_component")).select(F.col("id").alias("of_set"), "component_id")
    joined = corpus.nodes.select("doc_id", "n", "set_id").join(names, F.col("set_id") == F.col("of_set"), "left")
    component = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return joined.select("doc_id", F.col("n").cast("bigint").alias("n_shingles"), component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False))
    )
