"""Mixing sources to target weights by systematic sampling.

Within a source, documents stand in a fixed order, smallest first; each adds the
source's rate (expected copies) to a running sum that starts at one random offset, and is
emitted once per integer the sum crosses. As neighbours in that order are of about
the same size, the words taken stay close to the target.

The running sum needs each document's rank in its source. A window over a whole
source would put a hot source into one task, so ranks come from counts: a document
falls into a cell (source, size class, first bits of its digest), cell counts give
each cell its first rank, and a window ranks inside one cell only. The order in a class is
that of the digests, so it is the same for every number of cells; they grow in number with
the rows, so a cell stays small. Rows alike in key, source and size are numbered
first and enter the digest with their number, so a key that holds a large share of the rows is
spread like any other.

Defined cases: a NULL text has size 0, and a very long one counts whole; a NULL source is a source of
its own, ordered last; a source without words has target 0 and is not emitted; ties of the
order are broken by the digest; repeated rows are ranked one after another; an empty table
gives an empty mix. Extra columns pass through ``mix`` untouched. Distinct sources are
ranked in one task: some ten million of them are fine, whatever the number of documents.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricehouse.llm.rows import row_key
from pricehouse.llm.text import WORD, column, pick
from pricehouse.session import materialize

#: Weights given to the sources in order, repeating.
WEIGHTS = (3, 1, 2)

#: Words of the mix as a fraction (numerator, denominator) of all words.
SHARE = (3, 2)

#: No source is repeated more often than this.
MOST_COPIES = 2

#: Rows that a cell of one size class should hold about.
CELL_ROWS = 1 << 20

#: Seed of the random offsets.
SEED = "mix-1"


def size_of(text: Column) -> Column:
    """Number of words of a text, 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def _unit(text: Column) -> Column:
    """A number in [0, 1) from the first 52 bits of a text's digest."""
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("bigint") / F.lit(2.0**52)


def targets(
    sizes: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    share: tuple[int, int] = SHARE,
    most: int = MOST_COPIES,
    seed: str = SEED,
) -> DataFrame:
    """One row per source: source_size, target, rate and offset.

    Sharing out, capping at ``most`` times a source's size and sharing the excess
    again ends where every uncapped source has the same words per weight. Sources
    capped first are those with the smallest size per weight, so one pass over the
    sources in that order finds the level. A table of sources is small, whatever
    the number of documents.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last())
    listed = F.array(*[F.lit(w) for w in weights])
    weighed = totals.withColumn("weight", F.get(listed, (F.row_number().over(order) - 1) % len(weights)))
    by_need = Window.partitionBy(F.lit(0)).orderBy(
        F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last()
    )
    everything = Window.partitionBy(F.lit(0))
    before = by_need.rowsBetween(Window.unboundedPreceding, -1)
    after = by_need.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    cap = F.col("source_size") * most
    level = (
        F.sum("source_size").over(everything) * share[0] / F.lit(float(share[1]))
        - F.coalesce(F.sum(cap).over(before), F.lit(0))
    ) / F.sum("weight").over(after)
    levelled = weighed.withColumn("level", level).withColumn(
        "fits", F.col("level") * F.col("weight") <= cap
    )
    shared = F.max(F.when(F.col("fits"), F.struct(-F.col("source_size") / F.col("weight"), F.col("level"))))
    target = F.least(
        F.coalesce(shared.over(everything)["level"] * F.col("weight"), cap.cast("double")), cap.cast("double")
    )
    name = F.concat(F.lit(seed), F.lit("|"), F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("n")))
    return levelled.select("source", "source_size", target.alias("target")).select(
        "*",
        F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0)).alias("rate"),
        _unit(name).alias("offset"),
    )


def plan_mix(
    docs: DataFrame,
    key: Sequence[str] = ("doc_id",),
    weights: Sequence[int] = WEIGHTS,
    share: tuple[int, int] = SHARE,
    most: int = MOST_COPIES,
    seed: str = SEED,
    cell_rows: int = CELL_ROWS,
    more: Sequence[str] = (),
) -> DataFrame:
    """One row per row of ``docs``: key, ``more``, source, size, source_size, target, copies.

    ``docs`` has the key columns, text and source. Texts are read once; what is
    kept between the steps is a written table of keys and sizes.
    """
    given = [*key, *[c for c in more if c not in key]]
    named = pick(docs, [*given, *[c for c in ("source", "text") if c not in given]])
    kept = [column(c).alias(f"k_{c}") for c in given]
    sizes = named.select(*kept, "source", size_of(F.col("text")).alias("size"), F.monotonically_increasing_id().alias("row_at"))
    sizes = _numbered(materialize(sizes, "mix-sizes"), [*[f"k_{c}" for c in key], "source", "size"])
    bits = 0
    while cell_rows << bits < sizes.count():
        bits += 1
    ident = [F.coalesce(column(f"k_{c}").cast("string"), F.lit("-")) for c in key]
    digest = F.md5(F.concat_ws("|", F.lit(seed), *ident, F.col("nth").cast("string")))
    chunk = F.call_function("shiftright", F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint"), F.lit(32 - bits))
    placed = sizes.withColumns({"class": F.length(F.bin("size")) * 8 + _eighth(), "digest": digest, "chunk": chunk})
    cell = ["source", "class", "chunk"]
    counts = placed.groupBy(*cell).agg(F.count("*").alias("rows"))
    # A source has a few hundred classes; the cells of a class are a window of their own.
    classes = counts.groupBy("source", "class").agg(F.sum("rows").alias("rows"))
    firsts = _join(counts, _before(classes, ["source"], "class", "class_first").drop("rows"), ["source", "class"])
    firsts = _before(firsts, ["source", "class"], "chunk", "cell_first").drop("rows")
    goals = targets(sizes, weights, share, most, seed)
    firsts = _join(firsts, goals, ["source"])
    inside = F.row_number().over(Window.partitionBy(*cell).orderBy("digest"))
    ranked = _join(placed.withColumn("inside", inside), firsts, cell)
    rank = F.col("class_first") + F.col("cell_first") + F.col("inside")
    crossed = F.floor(rank * F.col("rate") + F.col("offset")) - F.floor(
        (rank - 1) * F.col("rate") + F.col("offset")
    )
    return ranked.select(
        *[column(f"k_{c}").alias(c) for c in given if c not in ("source", "size", "source_size", "target")],
        "source", "size", "source_size", "target",
        F.least(crossed, F.lit(most)).cast("bigint").alias("copies"),
    )


def _before(rows: DataFrame, by: Sequence[str], order: str, name: str) -> DataFrame:
    """Adds the rows of all smaller cells of the same group."""
    earlier = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn(name, F.coalesce(F.sum("rows").over(earlier), F.lit(0)))


def _numbered(rows: DataFrame, alike: Sequence[str], parts: int = 1024) -> DataFrame:
    """Adds ``nth``: the place of a row among those alike, which are interchangeable.

    Only keys of several rows are looked at. Their rows are counted in parts by their place in the
    written table, so the rows of one key are never sorted in one task.
    """
    keys = [column(c) for c in alike]
    part = F.pmod(F.xxhash64("row_at"), F.lit(parts))
    counts = rows.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1").drop("n")
    several = _join(rows.withColumn("part", part), counts, alike)
    sums = several.groupBy(*keys, "part").agg(F.count("*").alias("rows"))
    sums = _before(sums, [f"`{c}`" for c in alike], "part", "earlier").drop("rows")
    within = F.row_number().over(Window.partitionBy(*keys, "part").orderBy("row_at"))
    places = _join(several.withColumn("within", within), sums, [*alike, "part"])
    places = materialize(places.select(F.col("row_at").alias("place"), (F.col("earlier") + F.col("within")).alias("later")), "mix-repeats")
    joined = rows.join(places, F.col("row_at") == F.col("place"), "left")
    return materialize(joined.withColumn("nth", F.coalesce("later", F.lit(1))).drop("place", "later", "row_at"), "mix-rows")


def _eighth() -> Column:
    """Which eighth of its power of two a size lies in."""
    top = F.length(F.bin("size"))
    return F.when(
        F.col("size") >= 8,
        F.call_function("shiftright", F.col("size"), top - 4).cast("int") - 8,
    ).otherwise(F.lit(0))


def _join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join on keys that may be NULL."""
    other = right.select(*[column(c).alias(f"r_{c}") if c in keys else column(c) for c in right.columns])
    on = None
    for c in keys:
        test = column(c).eqNullSafe(column(f"r_{c}"))
        on = test if on is None else on & test
    return left.join(other, on).drop(*[f"r_{c}" for c in keys])


def mix(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` (doc_id, text, source and others), each as often as taken; same columns.

    A row is known by a digest of all its columns. Rows with one digest are equal, so what the
    plan takes of them is one of them, as often.
    """
    keyed = docs.select(F.struct(*[column(c) for c in docs.columns]).alias("row"), row_key(docs).alias("key"))
    named = keyed.select("key", F.col("row.source").alias("source"), F.col("row.text").alias("text"))
    plan = plan_mix(named.withColumn("key", F.hex("key")), ("key",), **options)
    totals = plan.groupBy("key").agg(F.sum("copies").alias("copies"), F.count("*").alias("alike")).filter("copies > 0")
    wanted = materialize(totals.select(F.unhex("key").alias("wanted"), "copies", "alike"), "mix-plan")
    on = F.col("key") == F.col("wanted")
    single = keyed.join(wanted.filter("alike = 1"), on).select("row", "copies")
    repeated = keyed.join(wanted.filter("alike > 1"), on).groupBy("key").agg(F.first("row").alias("row"), F.first("copies").alias("copies"))
    taken = single.unionByName(repeated.select("row", "copies"))
    times = F.sequence(F.lit(1).cast("bigint"), F.col("copies").cast("bigint"))
    return taken.select("row", F.explode(times).alias("copy")).select("row.*")
