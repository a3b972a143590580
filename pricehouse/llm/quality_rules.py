"""Quality rules: a threshold table compiled into one projection.

Every measure is a built-in expression over the words and lines of one text, so a
row is judged where it is read: no shuffle, no user function, nothing broadcast.

Defined cases: a NULL text counts as empty (no words, fails the base rule); ratios
of a text without words or lines are 0; a very long text is judged whole, in memory of some
times its size; bounds are inclusive, so a measure on one passes; repeated rows are judged one by one; an
empty table gives an empty result; other columns are left alone by ``judge`` and
passed on by ``keep_good``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricehouse.functions.parsing import compute_once
from pricehouse.llm.text import WORD, column, let, pick, words_of

#: Frequent function words of the four languages of the corpus (fixed values).
STOP_WORDS = (
    "the of and to in is that for it with as was on be by are this have from or "
    "le la les de des du et en un une que qui dans pour sur au avec est par pas "
    "der die das und zu den von ist mit im dem nicht ein eine auf sich für des auch an "
    "el los las y se del con para su al lo como más una es por"
).split()

#: Characters counted as symbols.
SYMBOLS = r"[^#*$%&|<>]+"

#: A text below this many words fails the base rule.
LEAST_WORDS = 50

#: Share of words inside repeated three-word windows that fails the base rule.
REPEAT_PERCENT = 50


@dataclass(frozen=True)
class Rule:
    """Bounds, both inclusive, of one measure."""

    measure: str
    at_least: float | None = None
    at_most: float | None = None

    def broken(self) -> Column:
        value, tests = F.col(self.measure), []
        if self.at_least is not None:
            tests.append(value < F.lit(float(self.at_least)))
        if self.at_most is not None:
            tests.append(value > F.lit(float(self.at_most)))
        if not tests:
            raise ValueError(f"rule on {self.measure} has no bound")
        return reduce(Column.__or__, tests)


#: The production table. The base rule is applied beside it.
RULES = (
    Rule("mean_word_chars", at_least=2.0, at_most=20.0),
    Rule("symbols_per_word", at_most=0.25),
    Rule("stop_word_ratio", at_least=0.02),
    Rule("dup_line_ratio", at_most=0.5),
)


def _repeat_words(words: Column) -> Column:
    """Words that lie in a three-word window found twice or more in the text.

    Each window becomes one long: the upper bits of its hash, then its position in
    as many bits as the text needs. A sort of plain longs brings equal windows
    together; those with an equal neighbour are then compared word by word.
    """
    n, zero = F.size(words), F.lit(0).cast("bigint")
    covered = let(
        F.length(F.bin(n)),
        lambda bits: let(
            F.call_function("shiftleft", F.lit(1).cast("bigint"), bits) - 1,
            lambda mask: _covered(_repeated_at(words, bits, mask)),
        ),
    )
    return F.when(n < 4, zero).otherwise(covered)


def _repeated_at(words: Column, bits: Column, mask: Column) -> Column:
    """Start positions, in order, of the windows that are found more than once."""
    zero = F.lit(0).cast("bigint")

    def upper(x: Column, y: Column) -> Column:
        return F.call_function("shiftrightunsigned", x.bitwiseXOR(y), bits) == zero

    def alike(x: Column, y: Column) -> Column:
        i, j = x.bitwiseAND(mask).cast("int"), y.bitwiseAND(mask).cast("int")
        return reduce(
            Column.__and__, [F.get(words, i + k) == F.get(words, j + k) for k in range(3)], upper(x, y)
        )

    def beside_equal(packed: Column, test: Callable[[Column, Column], Column]) -> Column:
        return F.filter(
            packed,
            lambda x, k: test(x, F.get(packed, k + 1)) | test(x, F.get(packed, k - 1)),
        )

    packed = F.transform(
        F.sequence(F.lit(0), F.size(words) - 3),
        lambda i: F.call_function(
            "shiftleft", F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)), bits
        ).bitwiseOR(i.cast("bigint")),
    )
    repeated = let(
        F.sort_array(packed),
        lambda p: let(beside_equal(p, upper), lambda q: beside_equal(q, alike)),
    )
    return F.sort_array(F.transform(repeated, lambda x: x.bitwiseAND(mask)))


def _covered(starts: Column) -> Column:
    """Words covered by three-word windows at the given sorted positions."""
    three = F.lit(3).cast("bigint")
    return let(
        starts,
        lambda at: F.aggregate(
            F.transform(at, lambda p, k: F.least(three, F.coalesce(F.get(at, k + 1) - p, three))),
            F.lit(0).cast("bigint"),
            lambda total, x: total + x,
        ),
    )


def _line_counts(text: Column) -> Column:
    """(n_lines, n_dup_lines) over the lines that have a word."""
    lines = F.filter(F.split(text, "\n", -1), lambda line: line.rlike(WORD))
    return let(
        lines,
        lambda x: F.struct(
            F.size(x).cast("bigint").alias("n_lines"),
            (F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("n_dup_lines"),
        ),
    )


def _ratio(part: str, whole: str) -> Column:
    return F.when(F.col(whole) > 0, F.col(part) / F.col(whole)).otherwise(F.lit(0.0))


def _counts(text: Column) -> Column:
    whole = F.coalesce(text, F.lit(""))
    stop = [F.lit(w) for w in dict.fromkeys(STOP_WORDS)]

    def of_words(w: Column) -> Column:
        return F.struct(
            F.size(w).cast("bigint").alias("n_words"),
            F.length(F.array_join(w, "")).cast("bigint").alias("word_chars"),
            F.size(F.filter(w, lambda x: x.isin(*stop))).cast("bigint").alias("n_stop_words"),
            _repeat_words(w).alias("n_repeat_words"),
            F.length(F.regexp_replace(whole, SYMBOLS, "")).cast("bigint").alias("n_symbols"),
            _line_counts(whole).alias("lines"),
        )

    return let(words_of(whole), of_words)


def judge(
    docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text", prefix: str = "_quality"
) -> DataFrame:
    """``docs`` with a struct column ``prefix`` of all measures and the verdict.

    The struct has the counts, the ratios, ``base_failed``, ``broken`` (measures of
    the rules the text breaks, comma-joined) and ``kept``.
    """
    while prefix in docs.columns:
        prefix = "_" + prefix
    counted = compute_once(docs, {prefix: _counts(F.col(text))})
    counts = [
        F.col(f"{prefix}.{c}").alias(c)
        for c in ("n_words", "word_chars", "n_symbols", "n_stop_words", "n_repeat_words")
    ] + [F.col(f"{prefix}.lines.{c}").alias(c) for c in ("n_lines", "n_dup_lines")]
    row = F.struct(*[column(c) for c in docs.columns]).alias("_row")
    wide = counted.select(row, *counts)
    wide = wide.withColumns(
        {
            "mean_word_chars": _ratio("word_chars", "n_words"),
            "symbols_per_word": _ratio("n_symbols", "n_words"),
            "stop_word_ratio": _ratio("n_stop_words", "n_words"),
            "dup_line_ratio": _ratio("n_dup_lines", "n_lines"),
            "base_failed": (F.col("n_words") < LEAST_WORDS)
            | (F.col("n_repeat_words") * 100 > F.col("n_words") * REPEAT_PERCENT),
        }
    )
    broken = F.concat_ws(",", *[F.when(rule.broken(), F.lit(rule.measure)) for rule in rules])
    verdict = wide.select("_row", F.struct(*[c for c in wide.columns if c != "_row"], broken.alias("broken")).alias("_q"))
    kept = ~F.col("_q.base_failed") & (F.col("_q.broken") == "")
    return verdict.select("_row.*", F.col("_q").withField("kept", kept).alias(prefix))


def keep_good(docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text") -> DataFrame:
    """The rows whose text passes the base rule and every rule; same columns."""
    judged = judge(docs, rules, text)
    return judged.filter(F.col(f"{judged.columns[-1]}.kept")).select(*[column(c) for c in docs.columns])


def report(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """One row per document: id, counts, ratios and verdicts."""
    judged = judge(pick(docs, ["doc_id", "text"]), rules)
    return judged.select("doc_id", f"{judged.columns[-1]}.*")
