"""Secret scans: fixed patterns plus a randomness test battery.

Patterns give the base spans. Besides, every long token (also the value
of ``name=value``, and each part of a path beside the whole) that mixes letters and
digits is tested for being a uniform random string over the alphabet inferred from
its characters: chi-squared on the symbol counts, the number of runs about the middle of
the alphabet, and the lag-one serial correlation. The smallest of the three
p-values, times three, is the token's p-value for "random".

Tokens of one length class form a family. In each family the Benjamini-Hochberg
step-up decides, over the whole corpus, which tokens are rejected as random; the
others count as secrets. Length classes keep short tokens, for which the tests
have little power, from setting the level for long ones. The families need counts only:
a table of classes and p-value steps, whose size is fixed.

Texts are read once. A row with the spans and p-value steps of each document is
written to the shared folder, so that the second step reads that and no text.

Defined cases: a NULL text counts as empty and has no spans; offsets are code
points, ends exclusive; very long texts and tokens are scanned whole, in time that grows with
their length; spans that start together are listed by kind; repeated rows are scanned one by one (and weigh as often in
the families); an empty table gives an empty result; only the named columns are read.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_right
from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricehouse.llm.text import pick, slices
from pricehouse.session import materialize

#: Kinds of spans in the order in which they are listed.
KINDS = ("assign", "access", "hex", "random")

_KEYWORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
_HEX = re.compile(r"[0-9a-f]{32,}")
#: Characters of the shortest token.
LEAST = 20
_TOKEN = re.compile(rf"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{{{LEAST},}}")

#: Alphabets tried in this order; the first that holds all characters is taken.
ALPHABETS = (
    "0123456789abcdef",
    "0123456789ABCDEF",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "0123456789abcdefghijklmnopqrstuvwxyz",
    "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_",
)
_INDEX = [{c: i for i, c in enumerate(a)} for a in ALPHABETS]

#: Upper bounds of the length classes; longer tokens form the last class.
LENGTHS = (24, 32, 48, 64, 96, 128, 256)

#: False discovery rate at which a token is rejected as random.
LEVEL = 0.05

#: P-values are kept as whole steps of -log10(p), so many to a unit, rounded down.
STEPS, LAST_STEP = 16, 16 * 40


def _tail(z: float) -> float:
    """Upper tail of the standard normal distribution."""
    return 0.5 * math.erfc(z / math.sqrt(2))


def randomness(token: str) -> float | None:
    """P-value of "a uniform random string", None where the battery does not apply."""
    body = token.rstrip("=")
    if not (any(c.isdigit() for c in body) and any(c.isalpha() for c in body)):
        return None
    index = next((x for x in _INDEX if all(c in x for c in body)), None)
    if index is None:
        return None
    values = [index[c] for c in body]
    n, k = len(values), len(index)
    counts = [0] * k
    for v in values:
        counts[v] += 1
    chi = sum(c * c for c in counts) * k / n - n
    df = k - 1
    spread = 2 / (9 * df)  # Wilson-Hilferty
    p_chi = _tail(((max(chi, 0.0) / df) ** (1 / 3) - (1 - spread)) / math.sqrt(spread))
    upper = [v >= k / 2 for v in values]
    high = sum(upper)
    low = n - high
    runs = 1 + sum(a != b for a, b in zip(upper, upper[1:]))
    expected = 1 + 2 * high * low / n
    variance = (expected - 1) * (expected - 2) / (n - 1)
    p_runs = 2 * _tail(abs(runs - expected) / math.sqrt(variance)) if variance > 0 else 2.0 ** (1 - n)
    mean, scale = (k - 1) / 2, (k * k - 1) / 12
    serial = sum((a - mean) * (b - mean) for a, b in zip(values, values[1:])) / scale
    p_serial = 2 * _tail(abs(serial) / math.sqrt(n - 1))
    return min(1.0, 3 * min(p_chi, p_runs, p_serial))


def tokens_of(text: str) -> list[tuple[int, int]]:
    """Long runs of token characters, cut at each '=' that is no padding, and their parts between '/'."""
    found = set()
    for run in _TOKEN.finditer(text):
        body = run.group().rstrip("=")
        for piece in re.finditer(r"[^=]+", body):
            start, end = run.start() + piece.start(), run.start() + piece.end()
            padded = run.end() if piece.end() == len(body) else end
            found.add((start, padded))
            parts = [(start + x.start(), start + x.end()) for x in re.finditer(r"[^/]+", piece.group())]
            found.update((i, padded if j == end else j) for i, j in parts)
    return sorted(x for x in found if x[1] - x[0] >= LEAST)


def spans_of(text: str) -> list[tuple[int, int, int, int, int]]:
    """(start, kind, end, length class, p-value step) in order; the last two are -1 for base spans."""
    found: list[tuple[int, int, int, int, int]] = []
    plain = text.encode("utf-8", "replace").lower()
    if any(k in plain for k in _KEYWORDS):
        found += [(m.start(), 0, m.end(), -1, -1) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    found += [(m.start(), 1, m.end(), -1, -1) for m in _ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end(), -1, -1) for m in _HEX.finditer(text)]
    taken: list[list[int]] = []  # base spans, joined where they overlap
    for start, _, end, _, _ in sorted(found):
        if taken and start < taken[-1][1]:
            taken[-1][1] = max(taken[-1][1], end)
        else:
            taken.append([start, end])
    ends = [e for _, e in taken]
    for start, end in tokens_of(text):
        first = bisect_right(ends, start)
        if first < len(taken) and taken[first][0] < end:
            continue
        p = randomness(text[start:end])
        if p is not None:
            step = LAST_STEP if p <= 0 else min(LAST_STEP, int(-math.log10(p) * STEPS))
            found.append((start, 3, end, sum(end - start > x for x in LENGTHS), step))
    return sorted(found)


_SPAN = pa.struct([(n, pa.int32()) for n in ("start", "kind", "end", "family", "step")])
_SPANS = "spans array<struct<start:int,kind:int,end:int,family:int,step:int>>"


def _scanned(text: str, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole, text):
            names = batch.schema.names
            spans = [spans_of(x or "") for x in batch.column(names.index(text)).to_pylist()]
            base = [[s for s in x if s[1] < 3] for x in spans]
            digests = [
                hashlib.sha256(",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e, _, _ in x).encode()).hexdigest()
                for x in base
            ]
            counts = [pa.array([sum(s[1] == k for s in x) for x in base], pa.int64()) for k in range(3)]
            rows = [[dict(zip(("start", "kind", "end", "family", "step"), s)) for s in x] for x in spans]
            rest = [n for n in names if n != text]
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(names.index(n)) for n in rest], *counts,
                    pa.array(digests, pa.string()), pa.array(rows, pa.list_(_SPAN)),
                ],
                [*rest, "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
            )


def scan(docs: DataFrame, columns: Sequence[str] = ("doc_id",), text: str = "text") -> DataFrame:
    """``columns``, counts and digest of the base spans, and all spans with their p-value steps."""
    kept = [T.StructField(c, docs.schema[c].dataType) for c in columns]
    more = T.StructType.fromDDL(f"n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, {_SPANS}")
    return pick(docs, [*columns, text]).mapInArrow(
        lambda batches: _scanned(text, batches), T.StructType([*kept, *more.fields])
    )


def rejected_from(scanned: DataFrame, level: float = LEVEL) -> dict[int, int]:
    """For each length class, the p-value step from which tokens are rejected as random.

    Step-up rule: the largest p with p <= level * rank / tokens of the class. At most
    one row for each class reaches the driver.
    """
    tokens = scanned.select(F.explode("spans").alias("s")).filter("s.kind = 3").select("s.family", "s.step")
    counts = tokens.groupBy("family", "step").agg(F.count("*").alias("n"))
    family = Window.partitionBy("family")
    rank = F.sum("n").over(family.orderBy(F.col("step").desc()))
    p = F.pow(F.lit(10.0), -F.col("step") / STEPS)
    ranked = counts.withColumn("fits", p <= level * rank / F.sum("n").over(family))
    return {r[0]: r[1] for r in ranked.filter("fits").groupBy("family").agg(F.min("step")).collect()}


def accepted(spans: Column, limits: dict[int, int]) -> Column:
    """The base spans, and those random tokens that were not rejected."""

    def keep(s: Column) -> Column:
        limit = F.lit(LAST_STEP + 1)
        for family, step in sorted(limits.items()):
            limit = F.when(s["family"] == family, F.lit(step)).otherwise(limit)
        return (s["kind"] < 3) | (s["step"] < limit)

    return F.filter(spans, keep)


def find_secrets(
    docs: DataFrame, columns: Sequence[str] = ("doc_id",), text: str = "text", level: float = LEVEL
) -> DataFrame:
    """``columns``, n_assign, n_access, n_hex, base_sha256 and the accepted spans of each text."""
    scanned = materialize(scan(docs, columns, text), "secret-spans")
    limits = rejected_from(scanned, level)
    return scanned.withColumn("spans", accepted(F.col("spans"), limits))


def listed(spans: Column) -> Column:
    """Spans as kind:start:end, comma-joined."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(
            spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))
        ),
        ",",
    )


def redact(docs: DataFrame, text: str = "text", level: float = LEVEL, mark: str = "[secret]") -> DataFrame:
    """``docs`` with every accepted span of the text replaced; overlapping spans become one mark.

    The families are counted in a first pass over the texts and the spans found
    again in a second, which costs less than shuffling texts to join spans to them.
    NULL stays NULL.
    """
    limits = rejected_from(materialize(scan(docs, (), text).select("spans"), "secret-steps"), level)

    at = docs.columns.index(text)
    # Columns go by number: a name with a dot in it cannot be passed to the workers.
    numbered = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])

    def run(batches):
        for whole in batches:
            for batch in slices(whole, f"c{at}"):
                texts = [None if x is None else _masked(x, limits, mark) for x in batch.column(at).to_pylist()]
                yield batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))

    return numbered.mapInArrow(run, numbered.schema).toDF(*docs.columns)


def _masked(text: str, limits: dict[int, int], mark: str) -> str:
    parts, upto = [], 0
    for start, kind, end, family, step in spans_of(text):
        if kind == 3 and step >= limits.get(family, LAST_STEP + 1):
            continue
        if start >= upto:
            parts += [text[upto:start], mark]
        upto = max(upto, end)
    return "".join([*parts, text[upto:]])
