"""Mixing sources to target weights by entropy balancing.

Every source gets a target number of words. Documents get rates between 0 and
``MAX_COPIES`` that meet the targets and stay as close as the targets allow, in
the sense of entropy, to one copy each: the convex dual has one multiplier per
source, and a document's rate is its exponential tilt, ``2 e^v / (1 + e^v)``
with ``v = multiplier * size / mean size``, bounded by the cap. Multipliers come
from Newton steps on the dual, each one aggregation over all sources at once.
Documents of one source and size share a rate, so the steps run on the counts
by source and size.

Rates become whole copies per source from the longest documents to the
shortest, each size taking over the words that rounding left, so a source ends
within about its shortest documents' size of its target. Which documents of a
size get the extra copy is decided by a hash of their id; reruns agree.

Defined results: a NULL text has size 0; documents of size 0 get one copy;
a NULL source is a source, last in order; repeated rows are separate documents;
an empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from curbside.llm.text import word_count
from curbside.workspace import staged

# Source weights in turn, the share of all words to take, the cap on copies.
WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
MAX_COPIES = 2

# Newton steps end when every source is this near its target, or after so many.
TOLERANCE = 1e-9
MAX_STEPS = 60
# Hash ranges by which a large set of equal documents is ranked piece by piece.
RANGES = 4_096


def _source_key(source: Column) -> Column:
    """Never NULL, and in the order of the sources with NULL last."""
    return F.when(source.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), source))


def targets(sources: DataFrame, share: float = SHARE, weights: tuple = WEIGHTS) -> DataFrame:
    """Rows (key, source_size, target) from rows (key, source_size).

    Words are shared by weight; a source cannot take more than ``MAX_COPIES``
    times its size, and what it cannot take is shared again by weight. That
    settles at one number of words per unit of weight for all sources below
    their cap, found by walking the sources in order of cap per weight.
    """
    # One row per source: these windows see no documents.
    turn = (F.row_number().over(Window.orderBy("key")) - 1) % len(weights)
    listed = F.array(*[F.lit(float(w)) for w in weights])
    ranked = sources.withColumn("weight", F.get(listed, turn)).withColumn(
        "room", MAX_COPIES * F.col("source_size") / F.col("weight")
    )
    before = Window.orderBy("room", "key").rowsBetween(Window.unboundedPreceding, -1)
    onward = Window.orderBy("room", "key").rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    filled = F.coalesce(F.sum(MAX_COPIES * F.col("source_size")).over(before), F.lit(0))
    wanted = F.lit(share) * F.sum("source_size").over(everything)
    level = ranked.withColumn("level", (wanted - filled) / F.sum("weight").over(onward))
    common = F.max(F.when(F.col("level") <= F.col("room"), F.col("level"))).over(everything)
    target = F.least(
        MAX_COPIES * F.col("source_size").cast("double"), F.col("weight") * F.col("common")
    )
    return level.withColumn("common", common).select(
        "key",
        "source_size",
        F.coalesce(target, MAX_COPIES * F.col("source_size").cast("double")).alias("target"),
    )


def _rate(multiplier: Column, size: Column, mean: Column) -> Column:
    """A document's copies before rounding; a NULL multiplier takes all it may."""
    v = F.greatest(F.least(multiplier * size / mean, F.lit(700.0)), F.lit(-700.0))
    rate = MAX_COPIES / (1 + F.exp(-v))
    return F.when(multiplier.isNull(), F.lit(float(MAX_COPIES))).otherwise(rate)


def solve_duals(counts: DataFrame, sources: DataFrame) -> DataFrame:
    """Rows (key, source_size, target, mean, multiplier) for the tilts that meet the targets.

    ``counts`` holds (key, size, n). A step outside the bracket known to hold
    the root is replaced by its middle, so the steps always close in. A target
    at the cap has no finite multiplier and gets NULL.
    """
    mean = F.col("source_size") / F.greatest(F.col("filled"), F.lit(1))
    filled = counts.where("size > 0").groupBy("key").agg(F.sum("n").alias("filled"))
    at_cap = F.col("target") >= MAX_COPIES * F.col("source_size") * (1 - 1e-12)
    state = (
        sources.join(filled, "key", "left")
        .select("key", "source_size", "target", F.greatest(mean, F.lit(1.0)).alias("mean"))
        .withColumn("multiplier", F.when(at_cap, F.lit(None)).otherwise(F.lit(0.0)))
        .withColumn("low", F.lit(None).cast("double"))
        .withColumn("high", F.lit(None).cast("double"))
        .withColumn("off", F.lit(float("inf")))
    )
    state = staged(state, "mixing-state")
    open_sources = F.col("multiplier").isNotNull() & (F.col("off") > TOLERANCE)
    for _ in range(MAX_STEPS):
        if state.where(open_sources).isEmpty():
            break
        state = staged(_newton(counts, state), "mixing-state")
    return state.select("key", "source_size", "target", "mean", "multiplier")


def _newton(counts: DataFrame, state: DataFrame) -> DataFrame:
    tilted = counts.join(state.select("key", "mean", "multiplier"), "key")
    rate = _rate(F.col("multiplier"), F.col("size"), F.col("mean"))
    words = F.col("n") * F.col("size") * F.col("rate")
    slope = words * (1 - F.col("rate") / MAX_COPIES) * F.col("size") / F.col("mean")
    sums = (
        tilted.withColumn("rate", rate)
        .groupBy("key")
        .agg(F.sum(words).alias("words"), F.sum(slope).alias("slope"))
    )
    at, over = F.col("multiplier"), F.col("words") > F.col("target")
    low = F.when(over, F.col("low")).otherwise(at)
    high = F.when(over, at).otherwise(F.col("high"))
    full = at - (F.col("words") - F.col("target")) / F.col("slope")
    # Without a bracket on that side a step may at most double the distance from 0.
    reach = 2 * F.abs(at) + 1
    away = at - F.signum(F.col("words") - F.col("target")) * reach
    step = F.greatest(F.least(F.coalesce(full, away), at + reach), at - reach)
    outside = (step <= F.col("new_low")) | (step >= F.col("new_high"))
    middle = (F.col("new_low") + F.col("new_high")) / 2
    moved = F.when(outside & middle.isNotNull(), middle).otherwise(step)
    off = F.abs(F.col("words") - F.col("target")) / F.greatest(F.col("target"), F.lit(1.0))
    done = F.col("new_off") <= TOLERANCE
    return (
        state.drop("off")
        .join(sums, "key")
        .withColumn("new_off", off)
        .withColumn("new_low", low)
        .withColumn("new_high", high)
        .select(
            "key",
            "source_size",
            "target",
            "mean",
            F.when(done, at).otherwise(moved).alias("multiplier"),
            F.col("new_low").alias("low"),
            F.col("new_high").alias("high"),
            F.col("new_off").alias("off"),
        )
    )


def _carried(cells: pd.DataFrame) -> pd.DataFrame:
    """Extra copies for one source's sizes, longest first, carrying the words left over."""
    cells = cells.sort_values("size", ascending=False)
    carry, extras = 0.0, []
    for n, size, part in zip(cells["n"], cells["size"], cells["part"]):
        due = n * size * part + carry
        extra = min(max(round(due / size), 0), n) if size > 0 and part > 0 else 0
        carry = due - extra * size
        extras.append(int(extra))
    return cells.assign(extra=extras)[["key", "size", "n", "base", "extra"]]


def _prepared(docs: DataFrame, doc_id: str, text: str, source: str) -> DataFrame:
    """The documents with their source key, size and hash range."""
    return docs.withColumns(
        {
            "_mix_key": _source_key(F.col(source)),
            "_mix_size": word_count(F.col(text)),
            "_mix_place": F.pmod(F.xxhash64(F.col(doc_id)), F.lit(RANGES)).cast("int"),
        }
    )


def _plan(sized: DataFrame, share: float) -> tuple[DataFrame, DataFrame]:
    """Sources with target and multiplier; copies by (key, size, hash range)."""
    counts = sized.groupBy("_mix_key", "_mix_size").agg(F.count(F.lit(1)).alias("n"))
    counts = staged(counts.toDF("key", "size", "n"), "mixing-counts")
    sources = counts.groupBy("key").agg(F.sum(F.col("n") * F.col("size")).alias("source_size"))
    solved = solve_duals(counts, targets(sources, share))

    rate = _rate(F.col("multiplier"), F.col("size"), F.col("mean"))
    rate = F.when(F.col("size") == 0, F.lit(1.0)).otherwise(rate)
    base = F.least(F.floor("rate"), F.lit(MAX_COPIES)).cast("int")
    rated = (
        counts.join(solved.select("key", "mean", "multiplier"), "key")
        .withColumn("rate", rate)
        .select("key", "size", "n", base.alias("base"), (F.col("rate") - base).alias("part"))
    )
    # One row per size that a source has: at most the length of its longest text.
    cells = rated.groupBy("key").applyInPandas(
        _carried, "key string, size long, n long, base int, extra long"
    )
    # Whole hash ranges are ranked before the rows in them, so that no task ranks all
    # documents of one source and size.
    ranges = sized.groupBy("_mix_key", "_mix_size", "_mix_place").agg(F.count(F.lit(1)).alias("held"))
    ahead = Window.partitionBy("key", "size").orderBy("place")
    placed = (
        ranges.toDF("key", "size", "place", "held")
        .withColumn("ahead", F.sum("held").over(ahead) - F.col("held"))
        .join(cells.drop("n"), ["key", "size"])
        .select(
            F.col("key").alias("_mix_key"),
            F.col("size").alias("_mix_size"),
            F.col("place").alias("_mix_place"),
            (F.col("extra") - F.col("ahead")).alias("_mix_left"),
            F.col("base").alias("_mix_base"),
        )
    )
    return solved, staged(placed, "mixing-copies")


def _with_copies(prepared: DataFrame, placed: DataFrame, doc_id: str) -> DataFrame:
    cell = ["_mix_key", "_mix_size", "_mix_place"]
    order = [F.xxhash64(F.col(doc_id), F.lit(7)), F.col(doc_id)]
    rank = F.row_number().over(Window.partitionBy(*cell).orderBy(*order))
    copies = F.col("_mix_base") + (rank <= F.col("_mix_left")).cast("int")
    return prepared.join(placed, cell).withColumn("_mix_copies", copies)


def _sizes(docs: DataFrame, doc_id: str, text: str, source: str) -> DataFrame:
    numbers = _prepared(docs, doc_id, text, source).select(
        F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), "_mix_key", "_mix_size", "_mix_place"
    )
    return staged(numbers, "mixing-sizes")


def mix_rates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    share: float = SHARE,
) -> DataFrame:
    """Rows (doc_id, size, source_size, target, taken, copies, source), one per document.

    The texts are read once for their sizes; all else works on a stored table
    of a few numbers per document.
    """
    sized = _sizes(docs, doc_id, text, source)
    solved, placed = _plan(sized, share)
    totals = solved.select(F.col("key").alias("_mix_key"), "source_size", "target")
    return (
        _with_copies(sized, placed, "doc_id")
        .join(totals, "_mix_key")
        .select(
            "doc_id",
            F.col("_mix_size").alias("size"),
            "source_size",
            "target",
            (F.col("_mix_copies") * F.col("_mix_size")).alias("taken"),
            F.col("_mix_copies").alias("copies"),
            "source",
        )
    )


def mix_documents(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    share: float = SHARE,
) -> DataFrame:
    """The documents, each as often as the mix takes it; columns as given."""
    _, placed = _plan(_sizes(docs, doc_id, text, source), share)
    taken = _with_copies(_prepared(docs, doc_id, text, source), placed, doc_id)
    again = F.explode(F.array_repeat(F.lit(1), F.col("_mix_copies"))).alias("_mix_copy")
    return taken.select(*docs.columns, again).drop("_mix_copy")
