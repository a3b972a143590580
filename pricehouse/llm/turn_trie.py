"""Prefix trie of conversations, packed as double arrays per shard.

A conversation is a sequence of turns, a turn the digest of its role and text. Equal
sequences are one, with the number of conversations and the least conv_id. Sequences
are dealt by a prefix: by their first turn, and where one prefix holds more than
``SHARD_TURNS`` turns by its first 2, 4, 8, ... turns (the cut), so a hot first turn is
spread and no task gets an unbounded group. Prefixes are hashed into shards.

In a shard, turns get dense numbers and the sequences become a double-array trie: the
child of node ``s`` by turn ``t`` is ``BASE[s] + t``, valid if ``CHECK`` of it is ``s``.
The arrays are packed level by level, then traversed for the nodes and their counts. Nodes
at or below the cut are in one shard only and are final. Those above it are shared: their
counts, and what lies below them, are merged over all shards by the digest of their
prefix, with map-side combining, and passed up to all their ancestors.

Defined cases: rows without conv_id are ignored; NULL roles and texts are empty; rows of one
conversation go by turn (NULL first), ties by role and text; repeated rows are turns of their
own; a conversation that is rebuilt without turns is a member of the root; an empty table has
no nodes; other columns are ignored. A conversation's turn digests (about 100 bytes a
turn) must fit in a task, as must a shard; texts, however long, are only hashed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricehouse.llm.text import pick
from pricehouse.session import materialize

#: Turns that sequences with a common prefix may have before they are dealt by a longer one.
SHARD_TURNS = 1 << 15

#: Free cells that are tried for a node with several children before they go to the end.
_TRIES = 32

#: conv_ids that are joined to text at once: those that agree in all but so many low bits.
_ID_BITS = 16

_EMPTY = hashlib.sha256(b"").hexdigest()


def turn_lists(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns): each conversation's turns in order, as structs of digest and bytes of text."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = pick(conversations, ["conv_id", "turn", "role", "text"]).filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.struct(
            F.col("turn").isNotNull().alias("known"), F.coalesce(F.col("turn").cast("bigint"), F.lit(0)).alias("turn"),
            # Roles and texts decide ties by their own order, as far as 64 letters tell.
            F.left(role, F.lit(64)).alias("r"), F.left(text, F.lit(64)).alias("t"),
            F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)).alias("digest"),
            F.octet_length(text).cast("bigint").alias("bytes"),
        ).alias("row"),
    )
    listed = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("row")).alias("rows"))
    return listed.select(
        "conv_id", F.transform("rows", lambda r: F.struct(r["digest"].alias("digest"), r["bytes"].alias("bytes"))).alias("turns")
    )


def rebuilt(lists: DataFrame, own: int = 5, heads: int = 9) -> DataFrame:
    """Each conversation after the first turns of its base: the one whose id is a multiple of ``own``.

    The number of turns taken is crc32 of the decimal conv_id modulo ``heads``.
    """
    base = lists.filter(F.col("conv_id") % own == 0).select(
        F.col("conv_id").alias("base_id"), F.slice("turns", 1, heads - 1).alias("head")
    )
    count = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).cast("int")
    named = lists.select("conv_id", "turns", (F.col("conv_id") - F.col("conv_id") % own).alias("of_base"), count.alias("h"))
    joined = named.join(base, F.col("of_base") == F.col("base_id"), "left")
    none = F.array().cast(lists.schema["turns"].dataType)
    head = F.slice(F.coalesce("head", none), F.lit(1), F.col("h"))
    rest = F.slice(F.col("turns"), F.col("h") + 1, F.greatest(F.size("turns") - F.col("h"), F.lit(0)))
    return joined.select("conv_id", F.concat(head, rest).alias("turns"))


def _prefix(depth: int | Column) -> Column:
    """A key of the first turns of a sequence."""
    return F.md5(F.array_join(F.slice(F.transform("turns", lambda t: t["digest"]), F.lit(1), F.lit(depth)), ""))


def end_digests(members: DataFrame) -> DataFrame:
    """(sequence, ends_sha256): the digest of all conv_ids of each sequence, ascending and joined by commas.

    A digest is sequential. Ids are joined to text in blocks first, so what one task reads of
    a hot sequence is a row for each block of ids, taken as a stream.
    """
    blocks = members.groupBy("sequence", F.call_function("shiftright", F.col("conv_id"), F.lit(_ID_BITS)).alias("block")).agg(
        F.array_join(F.array_sort(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids")
    )
    return blocks.repartition("sequence").sortWithinPartitions("sequence", "block").mapInArrow(
        _hashed, "end_sequence string, ends_sha256 string"
    )


def _hashed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    name, digest = None, None

    def finished(names: list, digests: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(digests, pa.string())], ["end_sequence", "ends_sha256"])

    for batch in batches:
        names, digests = [], []
        for sequence, ids in zip(batch.column("sequence").to_pylist(), batch.column("ids").to_pylist()):
            if sequence == name:
                digest.update(b"," + ids.encode())
                continue
            if digest is not None:
                names.append(name)
                digests.append(digest.hexdigest())
            name, digest = sequence, hashlib.sha256(ids.encode())
        yield finished(names, digests)
    if digest is not None:
        yield finished([name], [digest.hexdigest()])


def sequences(conversations: DataFrame) -> DataFrame:
    """(conv_id, n_convs, turns, ends_sha256) of every distinct sequence; conv_id is its least member."""
    named = materialize(conversations.select("conv_id", _prefix(1 << 30).alias("sequence"), "turns"), "turn-sequences")
    members = named.select("conv_id", "sequence")
    least = members.groupBy("sequence").agg(F.min("conv_id").alias("least"), F.count("*").alias("n_convs"))
    digests = least.join(end_digests(members), F.col("sequence") == F.col("end_sequence")).select("least", "n_convs", "ends_sha256")
    return materialize(
        named.join(digests, F.col("conv_id") == F.col("least")).select("conv_id", "n_convs", "turns", "ends_sha256"),
        "distinct-sequences",
    )


def cut(distinct: DataFrame, most: int = SHARD_TURNS) -> DataFrame:
    """Adds ``cut`` and ``prefix``: the depth and key by which a sequence is dealt."""
    done, rest, depth = None, distinct, 1
    while True:
        keyed = rest.withColumn("prefix", _prefix(depth))
        loads = keyed.groupBy(F.col("prefix").alias("of_prefix")).agg(
            F.sum(F.size("turns").cast("bigint")).alias("load"), F.count("*").alias("rows")
        )
        large = materialize(loads.filter((F.col("load") > most) & (F.col("rows") > 1)).select("of_prefix"), "large-prefixes")
        last = large.isEmpty()
        small = (keyed if last else keyed.join(large, F.col("prefix") == F.col("of_prefix"), "left_anti")).withColumn("cut", F.lit(depth))
        done = small if done is None else done.unionByName(small)
        if last:
            return done
        rest = materialize(keyed.join(large, F.col("prefix") == F.col("of_prefix"), "left_semi").drop("prefix"), "long-prefixes")
        depth *= 2


class DoubleArray:
    """A trie over dense turn numbers, in two arrays."""

    def __init__(self, sequences: list[np.ndarray]):
        self.base, self.check = np.zeros(1, "i8"), np.full(1, -2, "i8")  # -1 is a free cell, the root has no parent
        self._free = 1
        lengths = np.array([len(s) for s in sequences], "i8")
        self.depths = int(lengths.max(initial=0))
        self.table = np.full((len(sequences), self.depths), -1, "i8")
        for row, s in zip(self.table, sequences):
            row[: len(s)] = s
        at = np.zeros(len(sequences), "i8")
        for depth in range(self.depths):
            going = np.flatnonzero(lengths > depth)
            edges = np.unique(np.stack([at[going], self.table[going, depth]], axis=1), axis=0)
            cuts = np.flatnonzero(np.diff(edges[:, 0])) + 1
            for children in np.split(edges, cuts):
                self._place(int(children[0, 0]), children[:, 1])
            at[going] = self.base[at[going]] + self.table[going, depth]

    def _grow(self, size: int) -> None:
        if size > len(self.check):
            more = max(size, 2 * len(self.check)) - len(self.check)
            self.base = np.concatenate([self.base, np.zeros(more, "i8")])
            self.check = np.concatenate([self.check, np.full(more, -1, "i8")])

    def _place(self, parent: int, turns: np.ndarray) -> None:
        """Give the children of a node cells that are free; ``turns`` ascend."""
        offsets, slot = turns - turns[0], self._free
        for _ in range(_TRIES):
            while slot < len(self.check) and self.check[slot] != -1:
                slot += 1
            cells = slot + offsets
            inside = cells[cells < len(self.check)]
            if (self.check[inside] == -1).all():
                break
            slot += 1
        else:
            slot = len(self.check)
        cells = slot + offsets
        self._grow(int(cells[-1]) + 1)
        self.base[parent] = slot - turns[0]
        self.check[cells] = parent
        while self._free < len(self.check) and self.check[self._free] != -1:
            self._free += 1

    def walk(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(depth, sequences, nodes) of every level: the node each sequence that is long enough passes."""
        going = np.arange(len(self.table))
        at = np.zeros(len(going), "i8")
        yield 0, going, at
        for depth in range(self.depths):
            turns = self.table[going, depth]
            going, at, turns = going[turns >= 0], at[turns >= 0], turns[turns >= 0]
            node = self.base[at] + turns
            if not (self.check[node] == at).all():
                raise ValueError("a turn leads to another node's child")
            at = node
            yield depth + 1, going, at


_NODES = (
    "prefix string, path array<string>, conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint,"
    " n_children bigint, n_leaves bigint, saved_tokens bigint, ends_sha256 string, bytes bigint, final boolean"
)


def _chain(before: str, digest: str) -> str:
    return hashlib.md5((before + digest).encode()).hexdigest()


def shard_nodes(table: pa.Table) -> pa.Table:
    """The nodes of a shard: final ones, and the shared ones above the cuts as parts to be merged.

    A shared node and a final child of one carry their prefix's key and those of their ancestors;
    a part's leaves and savings are those of the final nodes right below it.
    """
    turns = table.column("turns").to_pylist()
    digests = [[t["digest"] for t in x] for x in turns]
    number: dict[str, int] = {}
    coded = [np.array([number.setdefault(d, len(number)) for d in x], "i8") for x in digests]
    trie = DoubleArray(coded)
    size = len(trie.check)
    cuts, counts = np.array(table.column("cut").to_pylist(), "i8"), np.array(table.column("n_convs").to_pylist(), "i8")
    ids, ends = np.array(table.column("conv_id").to_pylist(), "i8"), table.column("ends_sha256").to_pylist()
    n_convs, depth_of, cut_of, width = (np.zeros(size, "i8") for _ in range(4))
    least, end_of = np.full(size, np.iinfo("i8").max), np.full(size, -1, "i8")
    some = np.zeros(size, "i8")  # a sequence that passes the node
    lengths = np.array([len(x) for x in coded], "i8")
    for depth, rows, nodes in trie.walk():
        np.add.at(n_convs, nodes, counts[rows])
        np.minimum.at(least, nodes, ids[rows])
        np.maximum.at(cut_of, nodes, cuts[rows])
        depth_of[nodes], some[nodes] = depth, rows
        ended = lengths[rows] == depth
        end_of[nodes[ended]] = rows[ended]
        if depth:
            width[nodes] = [turns[r][depth - 1]["bytes"] for r in rows.tolist()]
    used = np.flatnonzero(n_convs > 0)
    parent = trie.check
    n_children = np.bincount(parent[used[depth_of[used] > 0]], minlength=size)
    final = depth_of >= np.maximum(cut_of, 1)
    leaves, saved = ((n_children == 0) & final).astype("i8"), np.where(final, (n_convs - 1) * width, 0)
    kept_children = np.zeros(size, "i8")
    for node in used[np.argsort(-depth_of[used], kind="stable")].tolist():
        if depth_of[node] and final[node]:
            leaves[parent[node]] += leaves[node]
            saved[parent[node]] += saved[node]
            kept_children[parent[node]] += 1
    keys: dict[int, list[str]] = {}

    def path(node: int) -> list[str]:
        if node not in keys:
            row, steps = int(some[node]), [""]
            for digest in digests[row][: depth_of[node]]:
                steps.append(_chain(steps[-1], digest))
            keys[node] = steps
        return keys[node]

    out: list[tuple] = []
    for node in used.tolist():
        above = int(parent[node]) if depth_of[node] else None
        ended = ends[end_of[node]] if end_of[node] >= 0 else None
        steps, known = None, None
        if final[node]:
            if final[above]:
                known = int(least[above])
            else:
                steps = path(above)
            ended = ended or _EMPTY
        else:
            steps = path(node)
        out.append((
            None if final[node] else steps[-1], steps, int(least[node]), int(depth_of[node]), known, int(n_convs[node]),
            int(n_children[node] if final[node] else kept_children[node]), int(leaves[node]), int(saved[node]), ended,
            int(width[node]), bool(final[node]),
        ))
    kinds = [pa.string(), pa.list_(pa.string()), *[pa.int64()] * 7, pa.string(), pa.int64(), pa.bool_()]
    names = [c.split()[0] for c in _NODES.split(", ")]
    return pa.table([pa.array([r[i] for r in out], kind) for i, kind in enumerate(kinds)], names=names)


_REPORT = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def merged(nodes: DataFrame) -> DataFrame:
    """The shared nodes, each once, with what all shards know of them; ``prefix`` is their key."""
    parts = nodes.filter("NOT final")
    once = materialize(
        parts.groupBy("prefix").agg(
            F.min("conv_id").alias("conv_id"), F.min("depth").alias("depth"), F.sum("n_convs").alias("n_convs"),
            F.sum("n_children").alias("own_children"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved"),
            F.max("ends_sha256").alias("ends_sha256"), F.max("bytes").alias("bytes"), F.min("path").alias("path"),
        ),
        "shared-nodes",
    )
    parent = F.get("path", F.size("path") - 2)
    children = once.filter("depth > 0").groupBy(parent.alias("of_parent")).agg(
        F.count("*").alias("shared_children")
    )
    counted = once.join(children, F.col("prefix") == F.col("of_parent"), "left").withColumn(
        "n_children", F.col("own_children") + F.coalesce("shared_children", F.lit(0))
    )
    own = counted.select(
        F.explode("path").alias("ancestor"),
        (F.col("leaves") + (F.col("n_children") == 0).cast("bigint")).alias("leaves"),
        (F.col("saved") + (F.col("n_convs") - 1) * F.col("bytes")).alias("saved"),
    )
    below = own.groupBy("ancestor").agg(F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))
    return counted.join(below, F.col("prefix") == F.col("ancestor")).select(
        "prefix", F.when(F.col("depth") > 0, parent).alias("parent"), "conv_id", "depth", "n_convs", "n_children",
        "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(_EMPTY)).alias("ends_sha256"),
    )


def trie_nodes(conversations: DataFrame, most: int = SHARD_TURNS) -> DataFrame:
    """Every node of the trie of conversations (conv_id, turns), as ``report`` returns them."""
    distinct = sequences(conversations)
    turns = distinct.agg(F.sum(F.size("turns").cast("bigint"))).first()[0] or 0
    shards = max(1, -(-turns // most))
    dealt = cut(distinct, most).withColumn("shard", F.pmod(F.xxhash64("prefix"), F.lit(shards)))
    nodes = materialize(
        dealt.select("shard", "conv_id", "n_convs", "turns", "ends_sha256", "cut").groupBy("shard").applyInArrow(shard_nodes, _NODES),
        "trie-nodes",
    )
    shared = materialize(merged(nodes), "merged-nodes")
    above = shared.select(F.col("prefix").alias("above"), F.col("conv_id").alias("above_id"))
    upper = shared.join(above, F.col("parent") == F.col("above"), "left").withColumn("parent_conv_id", F.col("above_id"))
    final = nodes.filter("final")
    tops = final.filter("path IS NOT NULL").withColumn("parent", F.element_at("path", -1)).drop("parent_conv_id")
    tops = tops.join(above, F.col("parent") == F.col("above")).withColumn("parent_conv_id", F.col("above_id"))
    parts = [upper, tops, final.filter("path IS NULL")]
    first, *others = [p.select(*_REPORT) for p in parts]
    for p in others:
        first = first.unionByName(p)
    return first


def report(conversations: DataFrame, most: int = SHARD_TURNS) -> DataFrame:
    """The nodes of the trie of rebuilt conversations.

    conv_id (least member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens
    (bytes of text that members share with others, over the subtree) and ends_sha256.
    """
    return trie_nodes(rebuilt(turn_lists(conversations)), most)
