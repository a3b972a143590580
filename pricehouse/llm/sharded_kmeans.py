"""Centroid clustering: Lloyd's rounds over column blocks of the vectors.

Vectors become integers (``floor(1024 * x)``), so every sum and distance is exact. They are
cut into chunks of rows and shards of columns; a stored row holds the numbers of
one chunk in one shard, and a task never needs more than a block of columns. In a round

1. every (chunk, shard) works out partial squared distances to the slices of the
   centroids that lie in its columns,
2. the partial distances of a chunk are added and its vectors take the nearest centroid,
3. the labels go back to the shards, one byte a vector, each of which sums its own
   columns by label and so updates its own slices.

Shards are stored in buckets by (chunk, shard), so what a round shuffles is partial distances,
labels and sums, never vectors. The driver holds the centroids only. A
round reads the stored shards and the last centroids, so a lost executor costs its own tasks.

Defined cases: vectors that are NULL, of another length, or hold NULL, non-finite or, scaled,
numbers of 2**27 and more (whose distances need not fit in a long) take no part; repeated
rows are vectors of their own; a NULL vec_id takes part but starts no centroid unless the
others are too few; equal starts go by the vectors' order; fewer vectors than centroids leave fewer
centroids; equal distances go to the smaller number; an empty centroid stays; other columns
are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricehouse.llm.text import pick
from pricehouse.session import materialize, new_folder

#: Length of the vectors, centroids, rounds, seed of the starts and scale of the components.
LENGTH, CENTROIDS, ROUNDS, SEED, SCALE = 64, 8, 10, 3, 1024

#: Columns of a shard and vectors of a chunk.
COLUMNS, CHUNK = 16, 4096

_LIMIT = 1 << 27


def usable(vectors: DataFrame, length: int = LENGTH) -> DataFrame:
    """(vec_id, vector as doubles): those that take part."""
    named = pick(vectors, ["vec_id", "embedding"]).select(
        F.col("vec_id").cast("bigint"), F.col("embedding").cast("array<double>").alias("vector")
    )
    # A NULL or NaN component fails the comparison as well.
    small = F.forall("vector", lambda x: F.coalesce(F.abs(x) < _LIMIT / SCALE, F.lit(False)))
    return named.filter((F.size("vector") == length) & small)


def whole(vectors: np.ndarray) -> np.ndarray:
    return np.floor(SCALE * vectors).astype("i8")


def _matrix(column: pa.ListArray, length: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, length)


def _packed(numbers: np.ndarray) -> bytes:
    """A type letter and the numbers, as narrow as they allow."""
    top = int(np.abs(numbers).max(initial=0))
    kind = "i2" if top < 1 << 15 else "i4" if top < 1 << 31 else "i8"
    return kind.encode() + numbers.astype("<" + kind).tobytes()


def _unpacked(blob: bytes, width: int) -> np.ndarray:
    return np.frombuffer(blob, "<" + blob[:2].decode(), offset=2).astype("i8").reshape(-1, width)


_SHARDS = "chunk bigint, shard int, numbers binary, ids array<bigint>"


def _sharded(length: int, columns: int, size: int, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of (chunk, shard); the vec_ids are with the first shard of a chunk."""
    number = TaskContext.get().partitionId() << 32
    for batch in batches:
        for at in range(0, batch.num_rows, size):
            part = batch.slice(at, size)
            numbers = whole(_matrix(part.column("vector"), length))
            slices = [numbers[:, i : i + columns] for i in range(0, length, columns)]
            ids = [part.column("vec_id").to_pylist(), *[None] * (len(slices) - 1)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([number] * len(slices), pa.int64()), pa.array(range(len(slices)), pa.int32()),
                    pa.array([_packed(s) for s in slices], pa.binary()), pa.array(ids, pa.list_(pa.int64())),
                ],
                ["chunk", "shard", "numbers", "ids"],
            )
            number += 1


def starts(vectors: DataFrame, centroids: int = CENTROIDS, seed: int = SEED) -> np.ndarray:
    """The vectors with the least digests of seed and vec_id; at most ``centroids`` rows reach the driver."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = vectors.orderBy(digest.asc_nulls_last(), "vector").limit(centroids)
    return whole(np.array([r["vector"] for r in first.select("vector").collect()], "f8"))


def _partial(centroids: np.ndarray, columns: int, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Squared distances within a shard's columns, packed, one row a (chunk, shard)."""
    for batch in batches:
        out = []
        for shard, blob in zip(batch.column("shard").to_pylist(), batch.column("numbers").to_pylist()):
            own = centroids[:, shard * columns : (shard + 1) * columns]
            numbers = _unpacked(blob, own.shape[1])
            out.append(_packed(np.stack([((numbers - c) ** 2).sum(1) for c in own], axis=1)))
        yield pa.RecordBatch.from_arrays([batch.column("chunk"), pa.array(out, pa.binary())], ["chunk", "distances"])


def _nearest(chunk: pa.Table, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Labels and distances of a chunk from the partial distances of its shards."""
    total = sum(_unpacked(blob, k) for blob in chunk.column("distances").to_pylist())
    return total.argmin(1), total.min(1)


_LABELS = "chunk bigint, labels binary"


def _labelled(key: tuple, chunk: pa.Table, k: int) -> pa.Table:
    labels, _ = _nearest(chunk, k)
    return pa.table([pa.array([key[0].as_py()], pa.int64()), pa.array([_packed(labels)], pa.binary())], names=["chunk", "labels"])


_SUMS = "shard int, label int, members bigint, sums array<bigint>"


def _summed(length: int, columns: int, k: int, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of a shard's columns by label over all chunks of a task."""
    sums: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for batch in batches:
        for shard, blob, marks in zip(*(batch.column(c).to_pylist() for c in ("shard", "numbers", "labels"))):
            numbers, labels = _unpacked(blob, min(columns, length - shard * columns)), _unpacked(marks, 1)[:, 0]
            members, total = sums.setdefault(shard, (np.zeros(k, "i8"), np.zeros((k, numbers.shape[1]), "i8")))
            members += np.bincount(labels, minlength=k)
            for label in np.unique(labels):
                total[label] += numbers[labels == label].sum(0)
    rows = [(s, label, int(m[label]), t[label].tolist()) for s, (m, t) in sums.items() for label in range(k) if m[label]]
    kinds = (pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()))
    arrays = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
    yield pa.RecordBatch.from_arrays(arrays, ["shard", "label", "members", "sums"])


_PLACED = "vec_id bigint, cluster int, distance bigint"


def _placed(key: tuple, chunk: pa.Table, k: int) -> pa.Table:
    labels, distances = _nearest(chunk, k)
    ids = next(x for x in chunk.column("ids").to_pylist() if x is not None)
    return pa.table([pa.array(ids, pa.int64()), pa.array(labels, pa.int32()), pa.array(distances, pa.int64())], names=["vec_id", "cluster", "distance"])


class ShardedLloyd:
    """Shards of a table of vectors, and the steps of a round on them."""

    def __init__(self, vectors: DataFrame, length: int = LENGTH, columns: int = COLUMNS, chunk: int = CHUNK):
        self.spark: SparkSession = vectors.sparkSession
        self.length, self.columns, self.shards = length, columns, -(-length // columns)
        made = vectors.mapInArrow(lambda b: _sharded(length, columns, chunk, b), _SHARDS)
        self.buckets = max(1, int(self.spark.conf.get("spark.sql.shuffle.partitions")))
        self.name = f"vector_shards_{uuid.uuid4().hex}"
        stored = made.repartition(self.buckets, "chunk", "shard").write.bucketBy(self.buckets, "chunk", "shard")
        stored.option("path", new_folder(self.spark, "vector-shards")).saveAsTable(self.name)
        self.table = self.spark.table(self.name)

    def close(self) -> None:
        """Forget the table's name; its files stay in the work folder."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")

    def partial(self, centroids: np.ndarray) -> DataFrame:
        columns = self.columns
        return self.table.select("chunk", "shard", "numbers").mapInArrow(
            lambda b: _partial(centroids, columns, b), "chunk bigint, distances binary"
        )

    def labels(self, centroids: np.ndarray) -> DataFrame:
        """(chunk, labels): the nearest centroid of every vector."""
        k = len(centroids)
        return self.partial(centroids).groupBy("chunk").applyInArrow(lambda key, t: _labelled(key, t, k), _LABELS)

    def update(self, centroids: np.ndarray) -> np.ndarray:
        """One round: every shard's slices replaced by the floor of the mean of their vectors."""
        length, columns, k = self.length, self.columns, len(centroids)
        each = F.explode(F.sequence(F.lit(0), F.lit(self.shards - 1))).alias("of_shard")
        marks = self.labels(centroids).select(F.col("chunk").alias("of_chunk"), each, "labels")
        joined = self.table.join(marks, (F.col("chunk") == F.col("of_chunk")) & (F.col("shard") == F.col("of_shard")))
        sums = joined.select("shard", "numbers", "labels").mapInArrow(lambda b: _summed(length, columns, k, b), _SUMS)
        # At most shards x centroids rows, each of a shard's columns, come to the driver.
        added = sums.select("shard", "label", "members", F.posexplode("sums").alias("place", "part")).groupBy("shard", "label", "place").agg(
            F.sum(F.col("part").cast("decimal(38,0)")).alias("total"), F.sum("members").alias("members")
        )
        moved = centroids.copy()
        for row in added.collect():
            moved[row["label"], row["shard"] * columns + row["place"]] = int(row["total"]) // row["members"]
        return moved

    def assign(self, centroids: np.ndarray) -> DataFrame:
        """(vec_id, cluster, distance) of every vector."""
        k, columns = len(centroids), self.columns

        def partial(batches):
            for batch in batches:
                for out in _partial(centroids, columns, [batch]):
                    yield out.append_column("ids", batch.column("ids"))

        parts = self.table.mapInArrow(partial, "chunk bigint, distances binary, ids array<bigint>")
        return parts.groupBy("chunk").applyInArrow(lambda key, t: _placed(key, t, k), _PLACED)


def centroid_digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()


def cluster(
    vectors: DataFrame, centroids: int = CENTROIDS, rounds: int = ROUNDS, seed: int = SEED,
    length: int = LENGTH, columns: int = COLUMNS, chunk: int = CHUNK,
) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, cluster, distance, cluster_inertia, inertia) of every vector, and the final centroids."""
    known = usable(vectors, length)
    now = starts(known, centroids, seed)
    if not len(now):
        empty = "vec_id bigint, cluster int, distance bigint, cluster_inertia bigint, inertia bigint"
        return vectors.sparkSession.createDataFrame([], empty), now
    lloyd = ShardedLloyd(known, length, columns, chunk)
    for _ in range(rounds):
        now = lloyd.update(now)
    placed = materialize(lloyd.assign(now), "vector-clusters")
    lloyd.close()
    sums = {r["cluster"]: int(r["total"]) for r in placed.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()}
    own = F.get(F.array(*[F.lit(sums.get(i, 0)).cast("bigint") for i in range(len(now))]), F.col("cluster"))
    return placed.select("*", own.alias("cluster_inertia"), F.lit(sum(sums.values())).cast("bigint").alias("inertia")), now


def with_digests(placed: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Adds centroid_sha256, the digest of each row's centroid."""
    if not len(centroids):
        return placed.withColumn("centroid_sha256", F.lit(None).cast("string"))
    digests = F.array(*[F.lit(centroid_digest(c)) for c in centroids])
    return placed.withColumn("centroid_sha256", F.get(digests, F.col("cluster")))
