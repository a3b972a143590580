"""Token counts as totals maintained from signed deltas.

A change to the corpus is a batch of deltas: a new document counts plus its
tokens, a removed one minus, a revised one minus the old and plus the new count. A batch is
rolled up by source, language and tokenizer version, with map-side combining, and
committed under its id; totals are sums of committed rollups. Only a batch's rollup is
stored, so totals never depend on the number of documents.

A commit writes the rollup to the folder of its batch id and then a marker file of the
same name. Committing an id that has its marker changes nothing; a commit that was
cut short has none, is not counted, and is simply repeated. One driver commits a batch
at a time.

Defined cases: a NULL text has no tokens but counts as a document; NULL sources and
languages are groups of their own; repeated rows count as often as they come; an
empty batch commits and changes nothing; other columns are ignored. Very long texts are
counted whole, in one task; those with a very long run of white space, which the tokenizer's
own splitting can't hold, are split by the same pattern elsewhere and counted piece by piece. Ties
of repeated texts go to the least doc_id, all rows of which stay.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator, Mapping
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricehouse.llm.text import pick, slices

KEYS = ("source", "lang", "tokenizer")

_ROLLUP = "source string, lang string, tokenizer string, n_docs bigint, n_tokens bigint"



@lru_cache(maxsize=2)
def _byte_bpe(ranks_file: str, pattern: str):
    import base64

    import tiktoken

    with open(ranks_file, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("byte-bpe", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def words_counter() -> Callable[[str], int]:
    """Counts words between ASCII white space."""
    return lambda text: len(text.encode("utf-8", "replace").split())


#: White space in a row that the tokenizer's splitting is not trusted with (it fails at a million).
LONG_SPACE = 100_000

_SPACES = re.compile(r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{%d}" % LONG_SPACE)


def byte_bpe_counter(ranks_file: str, pattern: str) -> Callable[[str], int]:
    """Counts byte-level BPE tokens; a special token's string in a text is ordinary text."""

    def count(text: str) -> int:
        coder = _byte_bpe(ranks_file, pattern)
        if len(text) < LONG_SPACE or not _SPACES.search(text):
            return len(coder.encode_ordinary(text))
        import regex

        pieces = (m.group().encode("utf-8", "replace") for m in regex.finditer(pattern, text))
        return sum(len(coder._encode_single_piece(p)) for p in pieces)

    return count


def _counted(counters: Mapping[str, Callable[[str], int]], batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole, "text"):
            texts = batch.column(3).to_pylist()
            digests = [None if x is None else hashlib.sha256(x.encode("utf-8", "replace")).hexdigest() for x in texts]
            counts = [pa.array([count(x or "") for x in texts], pa.int64()) for count in counters.values()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(digests, pa.string()), *counts],
                ["doc_id", "source", "lang", "text_sha256", *[f"n{i}" for i in range(len(counters))]],
            )


def count_tokens(docs: DataFrame, counters: Mapping[str, Callable[[str], int]]) -> DataFrame:
    """doc_id, source, lang, tokenizer, n_tokens, text_sha256: a row for each document and tokenizer version."""
    columns = ", ".join(f"n{i} bigint" for i in range(len(counters)))
    named = pick(docs, ["doc_id", "source", "lang", "text"]).withColumn("doc_id", F.col("doc_id").cast("bigint"))
    wide = named.mapInArrow(
        lambda batches: _counted(counters, batches),
        f"doc_id bigint, source string, lang string, text_sha256 string, {columns}",
    )
    each = F.array(
        *[F.struct(F.lit(name).alias("tokenizer"), F.col(f"n{i}").alias("n_tokens")) for i, name in enumerate(counters)]
    )
    return wide.select("doc_id", "source", "lang", "text_sha256", F.inline(each)).select(
        "doc_id", "source", "lang", "tokenizer", "n_tokens", "text_sha256"
    )


def inserts(counts: DataFrame) -> DataFrame:
    """Deltas (source, lang, tokenizer, n_docs, n_tokens) of new documents."""
    return counts.select(*KEYS, F.lit(1).cast("bigint").alias("n_docs"), F.col("n_tokens").cast("bigint"))


def deletes(counts: DataFrame) -> DataFrame:
    """Deltas of removed documents, given their counts so far."""
    return inserts(counts).select(*KEYS, (-F.col("n_docs")).alias("n_docs"), (-F.col("n_tokens")).alias("n_tokens"))


def revisions(old: DataFrame, new: DataFrame) -> DataFrame:
    """Deltas of documents that were changed or counted anew."""
    return deletes(old).unionByName(inserts(new))


def roll_up(deltas: DataFrame) -> DataFrame:
    return deltas.groupBy(*KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))


class TokenTotals:
    """Totals in a shared folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _marker(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/commits/{name}")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def committed(self, batch_id: str) -> bool:
        files, path = self._marker(_name(batch_id))
        return files.exists(path) and files.getFileStatus(path).getLen() == len(_name(batch_id))

    def commit(self, batch_id: str, deltas: DataFrame) -> bool:
        """Add a batch once; False if the id was committed before."""
        if self.committed(batch_id):
            return False
        part = f"{self.folder}/rollups/part={_name(batch_id)}"
        roll_up(deltas).coalesce(1).write.mode("overwrite").parquet(part)
        files, path = self._marker(_name(batch_id))
        out = files.create(path, True)
        out.write(bytearray(_name(batch_id).encode()))
        out.close()
        return True

    def _named(self, folder: str) -> set[str]:
        files, path = self._marker("any")
        where = path.getParent().getParent().suffix(f"/{folder}")
        return {f.getPath().getName() for f in files.listStatus(where)} if files.exists(where) else set()

    def fold(self) -> None:
        """Sum up all committed batches as a base; later totals read it and newer batches only.

        The base names the batches it holds, and counts once it has a marker of its own, so a fold
        that was cut short changes nothing. Ids of folded batches stay known.
        """
        number = 1 + max((int(n) for n in self._named("folds")), default=0)
        folded, parts = self._parts()
        base = f"{self.folder}/bases/{number}"
        roll_up(self._stored(parts)).coalesce(1).write.mode("overwrite").parquet(f"{base}/rollup")
        names = [(n,) for n in sorted(folded | {p for p in self._named("commits") if self._whole(p)})]
        self.spark.createDataFrame(names, "name string").coalesce(1).write.mode("overwrite").parquet(f"{base}/names")
        files, path = self._marker("any")
        files.create(path.getParent().getParent().suffix(f"/folds/{number}"), False).close()

    def _whole(self, name: str) -> bool:
        files, path = self._marker(name)
        return files.getFileStatus(path).getLen() == len(name)

    def _parts(self) -> tuple[set[str], list[str]]:
        """The names of folded batches, and the folders that make up the totals."""
        number = max((int(n) for n in self._named("folds")), default=0)
        folded, parts = set(), []
        if number:
            base = f"{self.folder}/bases/{number}"
            folded = {r[0] for r in self.spark.read.parquet(f"{base}/names").collect()}
            parts.append(f"{base}/rollup")
        new = sorted(n for n in self._named("commits") - folded if self._whole(n))
        return folded, parts + [f"{self.folder}/rollups/part={n}" for n in new]

    def _stored(self, parts: list[str]) -> DataFrame:
        if not parts:
            return self.spark.createDataFrame([], _ROLLUP)
        return self.spark.read.schema(_ROLLUP).parquet(*parts)

    def totals(self) -> DataFrame:
        """source, lang, tokenizer, n_docs, n_tokens over all committed batches."""
        summed = roll_up(self._stored(self._parts()[1]))
        return summed.filter("n_docs <> 0 OR n_tokens <> 0")


def _name(batch_id: str) -> str:
    return "b" + hashlib.sha256(batch_id.encode()).hexdigest()


def repeats(counts: DataFrame) -> DataFrame:
    """The counts of documents whose text a document with a smaller id has as well.

    NULL texts are no copies of each other. The least id of each text is an aggregate
    joined back, so the copies of one text are never gathered.
    """
    firsts = counts.filter("text_sha256 IS NOT NULL").groupBy("text_sha256").agg(F.min("doc_id").alias("first_id"))
    firsts = firsts.withColumnRenamed("text_sha256", "of_text")
    return counts.join(firsts, (F.col("text_sha256") == F.col("of_text")) & (F.col("doc_id") > F.col("first_id"))).select(
        *counts.columns
    )


def repeat_deltas(counts: DataFrame) -> DataFrame:
    """Deltas that remove what ``repeats`` finds, from counts of the copies in place of their rows.

    Rows of one text are first counted by document, then by source and language, both combined before
    the shuffle; texts that occur once go before anything is joined.
    """
    group = ["text_sha256", *KEYS]
    known = counts.filter("text_sha256 IS NOT NULL AND doc_id IS NOT NULL")
    by_doc = known.groupBy(*group, "doc_id").agg(F.count("*").alias("n"), F.first("n_tokens").alias("n_tokens"))
    groups = by_doc.groupBy(*group).agg(
        F.sum("n").alias("n"), F.first("n_tokens").alias("n_tokens"), F.min(F.struct("doc_id", "n")).alias("least")
    )
    firsts = groups.groupBy("text_sha256").agg(F.min("least.doc_id").alias("first_id"), F.sum("n").alias("rows")).filter("rows > 1")
    firsts = firsts.select(F.col("text_sha256").alias("of_text"), "first_id")
    joined = groups.join(firsts, F.col("text_sha256") == F.col("of_text"))
    gone = F.col("n") - F.when(F.col("least.doc_id") == F.col("first_id"), F.col("least.n")).otherwise(0)
    return joined.select(*KEYS, (-gone).alias("n_docs"), (-gone * F.col("n_tokens")).alias("n_tokens")).filter("n_docs <> 0")
