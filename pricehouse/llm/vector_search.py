"""Approximate nearest neighbours by an adaptive scan of dimensions.

Vectors are turned by one random rotation, after which the first columns of a
difference tell about its length. Rows lie in the lists of their nearest centroids. In
each list a query probes (more than that where they hold too few), candidates are measured column block by column block, and a
candidate is dropped as soon as a test on the partial distance says that it is
farther than the tenth nearest so far (at ``d`` of ``D`` columns: partial distance
above the bound's share ``d / D``, widened by ``1 + EPSILON / sqrt(d)`` for the
chance of an unlucky rotation). What survives all blocks is measured on the original
vectors in double precision.

The centroids, and the number of lists a query must probe for ``RECALL`` on the
sample itself, are fitted on at most ``SAMPLE`` vectors, taken by a hash of their ids. Every
row is indexed. A list is worked on in blocks of ``BLOCK`` candidates and as many
queries, so a hot list is many small tasks, and no task grows with the data.

Defined cases: vectors that are NULL, zero, of another length than most, or hold NULL
or non-finite components take no part; a vec_id names a vector: a row with a query's
own id is no candidate of it, a repeated candidate is listed once, a repeated query is
asked once (the least vector in array order); a NULL vec_id takes no part; equal distances go
by smaller vec_id; fewer than ``k`` candidates in the table give fewer rows; an empty table
none. About one row in a hundred asks and most lists are probed where vectors have no clusters, so
work then grows with the square of the table, in blocks of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricehouse.llm.text import pick
from pricehouse.session import materialize

#: Bound of the fitting sample, and the share of true neighbours to reach in it.
SAMPLE, RECALL = 8192, 0.97

#: Width of the tests: at 2.1 about one in a hundred true neighbours fails any of them.
EPSILON = 2.1

#: Columns to a block, candidates and queries to a block.
COLUMNS, BLOCK = 16, 8192

#: Bound of the number of lists.
MOST_LISTS = 1024


@dataclass(frozen=True)
class Index:
    """What a task needs to know: bounded by the sample, the lists and the dimensions."""

    rotation: np.ndarray
    centroids: np.ndarray
    probes: int


def _numbers(vectors: Column) -> Column:
    return vectors.cast("array<double>")


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, vector): those that take part, all of one length."""
    inf = F.lit(float("inf"))
    named = pick(vectors, ["vec_id", "embedding"]).select(
        F.col("vec_id").cast("bigint"), _numbers(F.col("embedding")).alias("vector")
    )
    sound = named.filter(
        F.col("vec_id").isNotNull()
        & F.forall("vector", lambda x: x.isNotNull() & (F.abs(x) < inf))
        & F.exists("vector", lambda x: x != 0)
    )
    lengths = sound.groupBy(F.size("vector").alias("n")).agg(F.count("*").alias("rows"))
    most = lengths.orderBy(F.desc("rows"), F.desc("n")).first()
    return sound.filter(F.size("vector") == (most["n"] if most else 0))


def _squares(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (centres**2).sum(1) - 2 * x @ centres.T


def _kmeans(sample: np.ndarray, lists: int, rounds: int = 10) -> np.ndarray:
    rng = np.random.default_rng(10)
    centres = sample[rng.permutation(len(sample))[:lists]].copy()
    for _ in range(rounds):
        nearest = _squares(sample, centres).argmin(1)
        for k in range(len(centres)):
            own = sample[nearest == k]
            if len(own):
                centres[k] = own.mean(0)
    return centres


def _probes(sample: np.ndarray, centres: np.ndarray, k: int, recall: float) -> int:
    """Lists to probe so that 256 sample queries find ``recall`` of their neighbours in the sample."""
    asked = sample[:256]
    apart = (sample**2).sum(1) - 2 * asked @ sample.T
    apart[np.arange(len(asked)), np.arange(len(asked))] = np.inf
    near = np.argsort(apart, axis=1)[:, : min(k, len(sample) - 1)]
    order = np.argsort(_squares(asked, centres), axis=1)
    place = np.empty_like(order)
    np.put_along_axis(place, order, np.arange(len(centres))[None, :], axis=1)
    needed = np.sort(np.take_along_axis(place, _squares(sample, centres).argmin(1)[near], axis=1), axis=None)
    if not needed.size:
        return len(centres)
    return int(needed[min(needed.size - 1, int(np.ceil(recall * needed.size)))]) + 1


def fit(vectors: DataFrame, rows: int, k: int = 10, sample: int = SAMPLE, recall: float = RECALL) -> Index | None:
    """Rotation, centroids and probe count from a bounded sample; None without vectors."""
    order = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample)
    taken = np.array([r[0] for r in order.select("vector").collect()], "f8")
    if not len(taken):
        return None
    lists = max(1, min(MOST_LISTS, len(taken), round(rows**0.5 / 2)))
    centres = _kmeans(taken, lists)
    turned, _ = np.linalg.qr(np.random.default_rng(11).normal(size=(taken.shape[1],) * 2))
    return Index(turned, centres, _probes(taken, centres, k, recall))


def _matrix(column: pa.ListArray) -> np.ndarray:
    values = column.flatten().to_numpy()
    return values.reshape(len(column), -1) if len(column) else values.reshape(0, 1)


def _listed(index: Index, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        nearest = _squares(_matrix(batch.column(1)), index.centroids).argmin(1)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(nearest.astype("int32"))], ["vec_id", "vector", "list"]
        )


def _probed(index: Index, sizes: np.ndarray, k: int, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The lists of each query: as many as fitted, and on until they hold k ids beside its own."""
    for batch in batches:
        order = np.argsort(_squares(_matrix(batch.column(1)), index.centroids), axis=1)
        held = np.cumsum(sizes[order], axis=1)
        needed = np.maximum(index.probes, (held < k + 1).sum(1) + 1)
        lists = [row[:n].astype("int32") for row, n in zip(order, needed.tolist())]
        column = pa.array(lists, pa.list_(pa.int32()))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), column], ["query_id", "query", "lists"])


def scan_block(index: Index, asked: np.ndarray, ids: np.ndarray, vectors: np.ndarray, own: int, k: int, turned: np.ndarray):
    """The ``k`` nearest of a block to one query: (squared distances, ids), nearest first."""
    width = vectors.shape[1]
    query = asked @ index.rotation
    best, names = np.empty(0), np.empty(0, "int64")
    for at in range(0, len(ids), 1024):
        alive = np.arange(at, min(at + 1024, len(ids)))
        alive = alive[ids[alive] != own]
        partial = np.zeros(len(alive))
        bound = best[-1] * (1 + 1e-9) if len(best) == k else np.inf
        for begin in range(0, width, COLUMNS):
            end = min(begin + COLUMNS, width)
            partial = partial + ((turned[alive, begin:end] - query[begin:end]) ** 2).sum(1)
            share = end / width * (1 + EPSILON / end**0.5) ** 2 if end < width else 1.0
            stay = partial <= bound * share
            alive, partial = alive[stay], partial[stay]
        exact = ((vectors[alive] - asked) ** 2).sum(1)
        best, names = np.concatenate([best, exact]), np.concatenate([names, ids[alive]])
        order = np.lexsort((names, best))
        order = order[np.sort(np.unique(names[order], return_index=True)[1])][:k]
        best, names = best[order], names[order]
    return best, names


_FOUND = "query_id bigint, vec_id bigint, score double"


def _searched(index: Index, k: int, queries: pa.Table, candidates: pa.Table) -> pa.Table:
    out: list[list] = [[], [], []]
    if queries.num_rows and candidates.num_rows:
        ids = candidates.column("vec_id").to_numpy()
        vectors = _matrix(candidates.column("vector").combine_chunks())
        turned = vectors @ index.rotation
        asked = _matrix(queries.column("query").combine_chunks())
        for own, query in zip(queries.column("query_id").to_pylist(), asked):
            best, names = scan_block(index, query, ids, vectors, own, k, turned)
            out[0] += [own] * len(names)
            out[1] += names.tolist()
            out[2] += np.sqrt(best).tolist()
    kinds = (pa.int64(), pa.int64(), pa.float64())
    return pa.table([pa.array(x, t) for x, t in zip(out, kinds)], names=["query_id", "vec_id", "score"])


def _blocks(counts: DataFrame, rows: str, blocks: str, block: int) -> DataFrame:
    """(list, number of blocks): one row for each list, at most ``MOST_LISTS``."""
    return counts.select(F.col("list").alias(f"{blocks}_list"), F.ceil(F.col(rows) / block).cast("int").alias(blocks))


def search(vectors: DataFrame, is_query: Column, k: int = 10, block: int = BLOCK, **fitting) -> DataFrame:
    """(query_id, rank, vec_id, score): the nearest found of every vector for which ``is_query`` holds.

    ``is_query`` is a condition on vec_id. Score is the Euclidean distance.
    """
    known = usable(vectors)
    rows = known.count()
    index = fit(known, rows, k, **fitting)
    if index is None:
        return vectors.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    listed = materialize(
        known.mapInArrow(lambda b: _listed(index, b), "vec_id bigint, vector array<double>, list int"), "vector-lists"
    )
    once = listed.filter(is_query).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    # Each id counts in one list only; there are at most MOST_LISTS rows.
    ids = listed.groupBy("vec_id").agg(F.min("list").alias("list")).groupBy("list").agg(F.count("*").alias("n"))
    held = np.zeros(len(index.centroids), "int64")
    for row in ids.collect():
        held[row["list"]] = row["n"]
    probing = once.mapInArrow(
        lambda b: _probed(index, held, k, b), "query_id bigint, query array<double>, lists array<int>"
    ).select("query_id", "query", F.explode("lists").alias("list"))
    sizes = _blocks(listed.groupBy("list").agg(F.count("*").alias("n")), "n", "c_blocks", block)
    loads = _blocks(probing.groupBy("list").agg(F.count("*").alias("n")), "n", "q_blocks", block)
    plan = materialize(sizes.join(loads, F.col("c_blocks_list") == F.col("q_blocks_list")), "vector-blocks").select(
        F.col("c_blocks_list").alias("of_list"), "c_blocks", "q_blocks"
    )
    places = [F.sequence(F.lit(0), F.col(b) - 1) for b in ("c_blocks", "q_blocks")]
    candidates = listed.join(plan, F.col("list") == F.col("of_list")).select(
        "vec_id", "vector", "list",
        F.pmod(F.xxhash64("vec_id"), "c_blocks").cast("int").alias("c_block"), F.explode(places[1]).alias("q_block"),
    )
    queries = probing.join(plan, F.col("list") == F.col("of_list")).select(
        "query_id", "query", "list",
        F.explode(places[0]).alias("c_block"), F.pmod(F.xxhash64("query_id"), "q_blocks").cast("int").alias("q_block"),
    )
    cell = ["list", "c_block", "q_block"]
    found = queries.groupBy(*cell).cogroup(candidates.groupBy(*cell)).applyInArrow(
        lambda q, c: _searched(index, k, q, c), _FOUND
    )
    best = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return best.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
