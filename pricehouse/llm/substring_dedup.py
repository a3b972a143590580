"""Substring dedup with fixed-block anchors.

A word goes if it lies in a window of 13 words that also starts in a document with a
smaller doc_id. Any window of 13 words holds one whole block of 7 at a position that is
a multiple of 7 in its own document. So it is enough to index those blocks
(non-overlapping), to probe the index with every rolling window of 7 words, and to
extend the hits: only windows of 13 around a hit can be repeats, and those are
compared by 96 bits of hash. The union of the repeated windows is the maximal repeats.

Documents are dealt by hash into cells of about ``CELL_BYTES`` of text; all three
reads of a text share one shuffle of it. Between cells go packed, sorted hashes:

1. A cell sends each hash part the block hashes and the probe hashes it has, once
   each (40 bits beside the part's own, as differences). A part answers every cell with those hashes
   that are a block somewhere and are found in two cells or more. Truncated hashes may
   give false hits, which the next step removes, but never miss one.
2. A cell sends the windows around its hits with the least doc_id it has for each. A
   part answers a cell with the windows for which another cell has a smaller one.
3. A cell removes windows that were answered, and those it has itself under a
   smaller doc_id.

A passage shared by many documents is one hash for each cell, so no part is hot; the
numbers of cells and parts follow from the size of the texts.

Defined cases: NULL and wordless texts have no words and the digest of the empty
text; texts under 13 words stay whole; a very long text is read whole and its cell is larger
by it; rows equal in doc_id and text, or without doc_id and equal in text, share a cell, which must hold them; a NULL doc_id counts as larger than all others;
rows with equal doc_id do not remove each other's words; an empty table gives an empty
result; only doc_id and text are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricehouse.llm.text import pick

#: Words to a window.
WINDOW = 13

#: Bytes of text to a cell and hashes to a part, about.
CELL_BYTES, PART_HASHES = 12 << 20, 4 << 20

#: Bytes of a probe hash that are sent, beside the bits that name its part.
PROBE_BYTES = 5

#: Windows hashed at once.
_STRIDE = 1 << 14

_LAST = np.iinfo("int64").max  # in place of a NULL doc_id


class _WordHashes(dict):
    """64-bit hashes of words, kept while there are not too many."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        value = xxhash.xxh64_intdigest(word)
        if len(self) < 400_000:
            self[word] = value
        return value


_HASHES = _WordHashes()


def _rolled(words: np.ndarray, width: int, base: int) -> np.ndarray:
    """Hashes of all windows of ``width`` words."""
    out = np.empty(max(0, len(words) - width + 1), "u8")
    for at in range(0, len(out), _STRIDE):
        total = out[at : at + _STRIDE]  # a view small enough for the processor's cache
        total[:] = 0
        for k in range(width):
            total *= np.uint64(base)
            total += words[at + k : at + k + len(total)]
        total ^= total >> np.uint64(30)
        total *= np.uint64(0xBF58476D1CE4E5B9)
        total ^= total >> np.uint64(27)
        total *= np.uint64(0x94D049BB133111EB)
        total ^= total >> np.uint64(31)
    return out


_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)


def split_words(text: bytes | None) -> list[bytes]:
    return (text or b"").split()


def hash_words(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_HASHES.__getitem__, words), "u8", len(words))


class Cell:
    """The documents of a cell: their words as one array of hashes."""

    def __init__(self, table: pa.Table, window: int):
        self.window, self.block = window, (window + 1) // 2
        self.ids = np.array([_LAST if x is None else x for x in table.column("doc_id").to_pylist()], "i8")
        self.texts = table.column("text")
        hashed = [hash_words(split_words(text.as_py())) for text in self.texts]
        self.sizes = np.array([len(h) for h in hashed], "i8")
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.words = np.concatenate(hashed) if hashed else np.empty(0, "u8")

    def places(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """(first words, documents by number) of all windows that lie inside one document."""
        counts = np.maximum(self.sizes - width + 1, 0)
        docs = np.repeat(np.arange(len(counts)), counts)
        first = np.arange(len(docs)) + np.repeat(self.starts - (np.cumsum(counts) - counts), counts)
        return first, docs

    def anchors(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(first words, documents, block-sized window hashes, whether each is an indexed block)."""
        first, docs = self.places(self.block)
        return first, docs, _rolled(self.words, self.block, _BASES[0])[first], (first - self.starts[docs]) % self.block == 0


class Groups:
    """Equal values of an array, which need not be sorted."""

    def __init__(self, *columns: np.ndarray):
        self.order = np.lexsort(columns[::-1]) if len(columns) > 1 else np.argsort(columns[0])
        ranked = [c[self.order] for c in columns]
        new = np.ones(len(self.order), bool)
        if len(new):
            new[1:] = np.logical_or.reduce([r[1:] != r[:-1] for r in ranked])
        self.first = np.flatnonzero(new)
        self.values = [r[self.first] for r in ranked]
        self.counts = np.diff(np.append(self.first, len(self.order)))

    def of(self, function: np.ufunc, values: np.ndarray) -> np.ndarray:
        """``function`` reduced over the values of each group."""
        return function.reduceat(values[self.order], self.first) if len(self.first) else values[:0]

    def spread(self, values: np.ndarray) -> np.ndarray:
        """A value of each group, at all places of the group."""
        out = np.empty(len(self.order), values.dtype)
        out[self.order] = np.repeat(values, self.counts)
        return out


def _joined(parts: list[np.ndarray], kind) -> np.ndarray:
    return np.concatenate(parts) if parts else np.empty(0, kind)


def _found(sought: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which of the sorted values ``sought`` are among the sorted values ``known``."""
    if not len(known):
        return np.zeros(len(sought), bool)
    return known[np.minimum(np.searchsorted(known, sought), len(known) - 1)] == sought


def _short(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(part, the next ``PROBE_BYTES`` bytes) of 64-bit hashes."""
    part = hashes >> np.uint64(64 - bits) if bits else np.zeros(len(hashes), "u8")
    return part.astype("i8"), (hashes << np.uint64(bits)) >> np.uint64(64 - 8 * PROBE_BYTES)


def _pack(values: np.ndarray) -> bytes:
    """Sorted short hashes as differences of four bytes, or as they are if one is too large."""
    steps = np.diff(values, prepend=np.uint64(0))
    if not len(steps) or steps.max() < 1 << 32:
        return b"d" + steps.astype("<u4").tobytes()
    return b"w" + values.astype("<u8").tobytes()


def _unpack(blob: bytes) -> np.ndarray:
    if not blob:
        return np.empty(0, "u8")
    if blob[:1] == b"d":
        return np.cumsum(np.frombuffer(blob, "<u4", offset=1), dtype="u8")
    return np.frombuffer(blob, "<u8", offset=1)


def _by_part(part: np.ndarray) -> Iterator[tuple[int, slice]]:
    """Runs of equal numbers in a sorted array."""
    cuts = np.flatnonzero(np.diff(part)) + 1
    for i, j in zip([0, *cuts.tolist()], [*cuts.tolist(), len(part)]):
        if j > i:
            yield int(part[i]), slice(i, j)


_PROBES = "part bigint, cell bigint, blocks binary, others binary"


def send_probes(key: tuple, table: pa.Table, window: int, bits: int) -> pa.Table:
    """The distinct anchor hashes of a cell, by part: indexed blocks, and all others."""
    _, _, hashes, aligned = Cell(table, window).anchors()
    groups = Groups(hashes)
    indexed = groups.of(np.logical_or, aligned)
    blocks, others = groups.values[0][indexed], groups.values[0][~indexed]
    rows: dict[int, list[bytes]] = {}
    for place, sent in enumerate((blocks, others)):
        part, short = _short(sent, bits)  # sorted by hash, so by part
        for p, run in _by_part(part):
            rows.setdefault(p, [b"", b""])[place] = _pack(short[run])
    cell = key[0].as_py()
    return pa.table(
        [
            pa.array(list(rows), pa.int64()), pa.array([cell] * len(rows), pa.int64()),
            pa.array([r[0] for r in rows.values()], pa.binary()), pa.array([r[1] for r in rows.values()], pa.binary()),
        ],
        names=["part", "cell", "blocks", "others"],
    )


_ANSWER = "cell bigint, part bigint, hashes binary"


def answer_probes(key: tuple, table: pa.Table) -> pa.Table:
    """For each cell its hashes that are a block somewhere and are in two cells or more."""
    cells = table.column("cell").to_pylist()
    blocks = [_unpack(x) for x in table.column("blocks").to_pylist()]
    others = [_unpack(x) for x in table.column("others").to_pylist()]
    held = [x for pair in zip(blocks, others) for x in pair]
    groups = Groups(_joined(held, "u8"))  # a hash is sent once by each cell
    is_block = np.repeat([True, False] * len(cells), [len(x) for x in held])
    wanted = groups.spread((groups.counts > 1) & groups.of(np.logical_or, is_block))
    ends = np.cumsum([len(b) + len(o) for b, o in zip(blocks, others)])
    shared = [
        np.sort(np.concatenate([b, o])[wanted[end - len(b) - len(o) : end]]) for b, o, end in zip(blocks, others, ends)
    ]
    return _answers(cells, key[0].as_py(), shared, _pack)


def _answers(cells: list[int], part: int, shared: list[np.ndarray], pack) -> pa.Table:
    hits = [(c, pack(h)) for c, h in zip(cells, shared) if len(h)]
    return pa.table(
        [
            pa.array([c for c, _ in hits], pa.int64()), pa.array([part] * len(hits), pa.int64()),
            pa.array([h for _, h in hits], pa.binary()),
        ],
        names=["cell", "part", "hashes"],
    )


def _hits(cell: Cell, answers: pa.Table, bits: int) -> np.ndarray:
    """The first words of the anchors that are shared with another cell, or inside it."""
    first, docs, hashes, aligned = cell.anchors()
    part, short = _short(hashes, bits)
    groups = Groups((part.astype("u8") << np.uint64(8 * PROBE_BYTES)) | short)  # what was sent of a hash
    replies = [
        (np.uint64(p) << np.uint64(8 * PROBE_BYTES)) | _unpack(h)
        for p, h in zip(answers.column("part").to_pylist(), answers.column("hashes").to_pylist())
    ]
    outside = _found(groups.values[0], np.sort(_joined(replies, "u8")))
    owners = cell.ids[docs]
    inside = groups.of(np.minimum, owners) < groups.of(np.maximum, owners)
    return first[groups.spread(outside | inside & groups.of(np.logical_or, aligned))]


#: A window as sent: its first hash and half of its second.
_ROW = np.dtype([("first", "<u8"), ("second", "<u4")])

_WINDOWS = "part bigint, cell bigint, windows binary, places binary, owners binary"


def _windows(cell: Cell, first: np.ndarray) -> list[np.ndarray]:
    """96 bits of hash, in two arrays, of the windows that start at ``first``."""
    low = _rolled(cell.words, cell.window, _BASES[0])[first]
    return [low, (_rolled(cell.words, cell.window, _BASES[1])[first] >> np.uint64(32)).astype("u4")]


def send_windows(key: tuple, table: pa.Table, answers: pa.Table, window: int, bits: int) -> pa.Table:
    """The windows around the hits of a cell by part, each once with its least doc_id."""
    cell = Cell(table, window)
    hit = np.zeros(len(cell.words) + 1, "i4")
    hit[_hits(cell, answers, bits)] = 1
    before = np.cumsum(hit) - hit
    first, docs = cell.places(cell.window)
    near = before[first + cell.window - cell.block + 1] > before[first]
    first, docs = first[near], docs[near]
    groups = Groups(*_windows(cell, first))
    least = groups.of(np.minimum, cell.ids[docs])
    rows = np.empty(len(least), _ROW)
    rows["first"], rows["second"] = groups.values
    part, _ = _short(rows["first"], bits)
    columns: list[list] = [[], [], [], [], []]
    for p, run in _by_part(part):
        owners, places = np.unique(least[run], return_inverse=True)  # few doc_ids, and which of them
        places = places.astype("<u2" if len(owners) <= 1 << 16 else "<u4")
        sent = (p, key[0].as_py(), rows[run].tobytes(), places.tobytes(), owners.tobytes())
        for column, value in zip(columns, sent):
            column.append(value)
    kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
    names = ["part", "cell", "windows", "places", "owners"]
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def answer_windows(key: tuple, table: pa.Table) -> pa.Table:
    """For each cell its windows that another cell has under a smaller doc_id."""
    sent = [np.frombuffer(x, _ROW) for x in table.column("windows").to_pylist()]
    owners = []
    for ids, places in zip(table.column("owners").to_pylist(), table.column("places").to_pylist()):
        known = np.frombuffer(ids, "i8")
        owners.append(known[np.frombuffer(places, "<u2" if len(known) <= 1 << 16 else "<u4")])
    rows, owner = _joined(sent, _ROW), _joined(owners, "i8")
    groups = Groups(rows["first"], rows["second"])
    smaller = groups.spread(groups.of(np.minimum, owner)) < owner
    ends = np.cumsum([len(x) for x in sent])
    shared = [x[smaller[end - len(x) : end]] for x, end in zip(sent, ends)]
    return _answers(table.column("cell").to_pylist(), key[0].as_py(), shared, lambda x: x.tobytes())


_KEPT = "doc_id bigint, n_words bigint, n_removed bigint, text string"


def _removed(cell: Cell, answers: pa.Table) -> np.ndarray:
    """Which words of a cell go."""
    first, docs = cell.places(cell.window)
    low, high = _windows(cell, first)
    by_low = Groups(low)
    known = _joined([np.frombuffer(h, _ROW) for h in answers.column("hashes").to_pylist()], _ROW)
    # Only windows with a first hash that comes again here, or was answered, need a closer look.
    look = np.flatnonzero(by_low.spread((by_low.counts > 1) | _found(by_low.values[0], np.sort(known["first"]))))
    groups = Groups(
        np.concatenate([low[look], known["first"]]), np.concatenate([high[look], known["second"]])
    )
    owners = np.concatenate([cell.ids[docs[look]], np.full(len(known), np.iinfo("i8").min)])  # elsewhere: smaller
    gone = first[look[(groups.spread(groups.of(np.minimum, owners)) < owners)[: len(look)]]]
    edges = np.zeros(len(cell.words) + 1, "i4")
    edges[gone] += 1
    edges[gone + cell.window] -= 1
    return np.cumsum(edges[:-1]) > 0


def _remaining(table: pa.Table, answers: pa.Table, window: int, digest: bool) -> pa.Table:
    cell = Cell(table, window)
    removed = _removed(cell, answers)
    out, n_removed = [], []
    for text, start, size in zip(cell.texts, cell.starts.tolist(), cell.sizes.tolist()):
        mask, words = removed[start : start + size], split_words(text.as_py())
        n_removed.append(int(np.count_nonzero(mask)))
        kept = b" ".join([w for w, gone in zip(words, mask.tolist()) if not gone] if n_removed[-1] else words)
        out.append(hashlib.sha256(kept).hexdigest() if digest else kept.decode("utf-8", "replace"))
    ids, n_words = [None if i == _LAST else i for i in cell.ids.tolist()], cell.sizes
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
    columns = [pa.array(c, k) for c, k in zip((ids, n_words, n_removed, out), kinds)]
    return pa.table(columns, names=["doc_id", "n_words", "n_removed", "kept_sha256" if digest else "text"])


def dedup_substrings(docs: DataFrame, window: int = WINDOW, digest: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed and the kept words joined by one space, as ``text``.

    With ``digest`` the last column is ``kept_sha256`` instead of the text.
    """
    named = pick(docs, ["doc_id", "text"]).select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("binary").alias("text")
    )
    size = named.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    cells = max(1, -(-size // CELL_BYTES))
    bits = max(0, (size // 6 // PART_HASHES)).bit_length()  # about six bytes to a word
    dealt = named.select(F.pmod(F.xxhash64("doc_id", "text"), F.lit(cells)).alias("cell"), "doc_id", "text")
    probes = dealt.groupBy("cell").applyInArrow(lambda k, t: send_probes(k, t, window, bits), _PROBES)
    hits = probes.groupBy("part").applyInArrow(answer_probes, _ANSWER)
    windows = dealt.groupBy("cell").cogroup(hits.groupBy("cell")).applyInArrow(
        lambda k, t, a: send_windows(k, t, a, window, bits), _WINDOWS
    )
    repeats = windows.groupBy("part").applyInArrow(answer_windows, _ANSWER)
    last = _KEPT.replace("text string", "kept_sha256 string") if digest else _KEPT
    return dealt.groupBy("cell").cogroup(repeats.groupBy("cell")).applyInArrow(
        lambda k, t, a: _remaining(t, a, window, digest), last
    )
