"""SentencePiece encoding and decoding with a table of distinct chunks.

No piece of a suitable model holds a white-space marker after another character, so no
piece spans the start of a marked word: a text falls into chunks, each a run of
markers with the characters up to the next marker, that are segmented independently.
Every task keeps a table of the chunks it has met, has the library segment each new
one once, and joins the ids back by position. The table is dropped when it outgrows
``TABLE_CHUNKS``; that bounds memory and never changes a result. For a model with
crossing pieces, or other text rules, each text is one chunk.

A table shared by all tasks would send every word of the corpus through two
shuffles; one per task sends none.

Defined cases: a NULL or empty text has only the begin and end ids and decodes to
the empty text; a very long text is encoded whole, chunk by chunk, and a very long chunk by
the library at once; repeated rows are encoded one by one; an empty table gives an empty
result; only doc_id and the text are read unless more columns are named.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator, Sequence
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from pricehouse.llm.text import pick, slices

MARK = "▁"
_CHUNK = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")

#: Chunks a task keeps at most.
TABLE_CHUNKS = 400_000


@lru_cache(maxsize=2)
def processor(model: str):
    """The loaded model; one per worker process."""
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=model)


@lru_cache(maxsize=2)
def separable(model: str) -> bool:
    """Whether texts of this model may be segmented chunk by chunk.

    Needs: no marker inside a piece after another character, texts taken as they
    are, and the marker put before the text rather than after words.
    """
    from sentencepiece import sentencepiece_model_pb2

    with open(model, "rb") as file:
        proto = sentencepiece_model_pb2.ModelProto.FromString(file.read())
    rules, train = proto.normalizer_spec, proto.trainer_spec
    plain = (
        not rules.precompiled_charsmap
        and rules.add_dummy_prefix
        and rules.escape_whitespaces
        and not rules.remove_extra_whitespaces
        and not train.treat_whitespace_as_suffix
        and train.model_type == train.BPE
    )
    own = proto.pieces[0].Type.USER_DEFINED
    return plain and not any(MARK in p.piece.lstrip(MARK) or p.type == own for p in proto.pieces)


def chunks_of(text: str) -> list[str]:
    """The marked chunks of a text; the first starts with the marker put before it."""
    return _CHUNK.findall(MARK + text.replace(" ", MARK)) if text else []


class ChunkTable(dict):
    """Chunk to row number; ids of row ``r`` are ``flat[starts[r]:starts[r] + counts[r]]``."""

    def __init__(self, model: str, most: int = TABLE_CHUNKS):
        self.model, self.sp, self.most = model, processor(model), most
        self.separate = separable(model)
        self.clear()

    def clear(self) -> None:
        super().clear()
        self.fresh: list[str] = []
        self.flat = np.array([self.sp.bos_id(), self.sp.eos_id()], "int32")
        self.starts, self.counts = np.array([0, 1]), np.array([1, 1])
        self.used = 2  # rows 0 and 1 are the begin and end ids

    def __missing__(self, chunk: str) -> int:
        self[chunk] = row = self.used
        self.fresh.append(chunk)
        self.used += 1
        return row

    def rows(self, text: str) -> np.ndarray:
        chunks = chunks_of(text) if self.separate else [text] if text else []
        return np.fromiter(map(self.__getitem__, chunks), "int64", len(chunks))

    def segment_fresh(self) -> None:
        """Have the library segment the chunks met since the last call."""
        if not self.fresh:
            return
        if self.separate:  # the library puts the first marker back
            ids = self.sp.encode([c[1:] for c in self.fresh], num_threads=1)
            lone = self.sp.piece_to_id(MARK)
            ids = [[lone] if c == MARK else x for c, x in zip(self.fresh, ids)]
        else:
            ids = self.sp.encode(self.fresh, num_threads=1)
        counts = np.fromiter(map(len, ids), "int64", len(ids))
        flat = np.fromiter(chain.from_iterable(ids), "int32", int(counts.sum()))
        self.starts = np.concatenate([self.starts, self.flat.size + np.cumsum(counts) - counts])
        self.counts = np.concatenate([self.counts, counts])
        self.flat = np.concatenate([self.flat, flat])
        self.fresh = []

    def encode(self, texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(offsets, ids) of the texts, with begin and end ids."""
        if self.used > self.most:
            self.clear()
        rows = []
        for text in texts:
            rows += [(0,), self.rows(text or ""), (1,)]
        self.segment_fresh()
        lengths = np.fromiter(map(len, rows), "int64", len(rows))
        at = np.concatenate(rows).astype("int64") if rows else np.empty(0, "int64")
        counts = self.counts[at]
        ends = np.cumsum(counts)
        take = np.arange(int(ends[-1]) if ends.size else 0) + np.repeat(self.starts[at] - (ends - counts), counts)
        last = np.cumsum(lengths)[2::3] - 1  # where each text's end id stands among the rows
        return np.concatenate([[0], ends[last]]), self.flat[take]


def _encoded(model: str, text: str, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches without their text but with ``ids``."""
    table = ChunkTable(model)
    for whole in batches:
        for batch in slices(whole, text):
            at = batch.schema.get_field_index(text)
            offsets, ids = table.encode(batch.column(at).to_pylist())
            column = pa.ListArray.from_arrays(pa.array(offsets.astype("int32")), pa.array(ids))
            rest = [n for n in batch.schema.names if n != text]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(batch.schema.get_field_index(n)) for n in rest], column], [*rest, "ids"]
            )


def _digested(model: str, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts and digests in place of ``ids``, after decoding them with the library."""
    sp = processor(model)
    for batch in batches:
        ids = batch.column(batch.schema.get_field_index("ids"))
        offsets, values = ids.offsets.to_numpy(), ids.values.to_numpy()
        n_tokens, coded, decoded = [], [], []
        for i, j in zip(offsets.tolist(), offsets[1:].tolist()):
            own = values[i:j]
            n_tokens.append(j - i)
            coded.append(hashlib.sha256(own.astype("<u4").tobytes()).hexdigest())
            decoded.append(hashlib.sha256(sp.decode(own.tolist()).encode()).hexdigest())
        rest = [n for n in batch.schema.names if n != "ids"]
        yield pa.RecordBatch.from_arrays(
            [
                *[batch.column(batch.schema.get_field_index(n)) for n in rest],
                pa.array(n_tokens, pa.int64()), pa.array(coded, pa.string()), pa.array(decoded, pa.string()),
            ],
            [*rest, "n_tokens", "ids_sha256", "decoded_sha256"],
        )


def _schema(df: DataFrame, columns: Sequence[str], more: str) -> T.StructType:
    kept = [T.StructField(c, df.schema[c].dataType) for c in columns]
    return T.StructType([*kept, *T.StructType.fromDDL(more).fields])


def encode(docs: DataFrame, model: str, columns: Sequence[str] = ("doc_id",), text: str = "text") -> DataFrame:
    """``columns`` and ``ids``: the ids of each whole text, begin and end included."""
    return pick(docs, [*columns, text]).mapInArrow(
        lambda batches: _encoded(model, text, batches), _schema(docs, columns, "ids array<int>")
    )


def decode(coded: DataFrame, model: str, columns: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``columns`` and ``text``: what the library's decode gives for ``ids`` (NULL: empty)."""

    def run(batches):
        sp = processor(model)
        for batch in batches:
            texts = [sp.decode(x or []) for x in batch.column(batch.schema.get_field_index("ids")).to_pylist()]
            rest = [batch.column(batch.schema.get_field_index(n)) for n in columns]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(texts, pa.string())], [*columns, "text"])

    return pick(coded, [*columns, "ids"]).mapInArrow(run, _schema(coded, columns, "text string"))


def digests(docs: DataFrame, model: str, columns: Sequence[str] = ("doc_id",), text: str = "text") -> DataFrame:
    """``columns``, n_tokens, ids_sha256 and decoded_sha256 after encoding and decoding each text."""
    return pick(docs, [*columns, text]).mapInArrow(
        lambda batches: _digested(model, _encoded(model, text, batches)),
        _schema(docs, columns, "n_tokens bigint, ids_sha256 string, decoded_sha256 string"),
    )
