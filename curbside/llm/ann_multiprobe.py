"""Approximate nearest neighbours by multiprobe p-stable hashing.

Vectors are cast on random Gaussian lines cut into cells of one width; the cells
on a table's lines name a bucket. A query visits, in every table, its own bucket
and those reached by the likeliest small moves, in order of estimated success:
moves across near cell borders first. Every bucket's exact best join the other
tables', and the nearest of all are returned.

Equal vectors are searched as one, so a vector held by a third of the rows costs
no more than any other. Buckets are compared in blocks of ``BLOCK`` vectors, so
no task holds a large bucket. A query that its buckets leave with too few
neighbours is compared with all vectors, block by block.

The width is fitted on ``SAMPLE`` vectors chosen by a hash: ``WIDTH`` times the
median distance to the tenth neighbour among them. Everything else covers all
rows. On vectors spread evenly over a 64-dimensional sphere, where neighbours are
hardly nearer than the rest, the defaults visit about 70 % of the rows for a
recall of 0.95; on clustered vectors far fewer.

Defined results: vectors NULL, zero, of another length than the sample's most
frequent, or holding NULL or non-finite components take no part; ties go to the
smaller id; repeated rows with the same id are one; an empty table gives an
empty result. Other columns are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from curbside.workspace import staged

TABLES = 6
LINES = 6
PROBES = 30
WIDTH = 1.8
SAMPLE = 2_000
BLOCK = 4_096
SEED = 11


@dataclass
class Hashing:
    """Random lines, offsets and the cell width."""

    lines: np.ndarray
    offsets: np.ndarray
    width: float
    mix: np.ndarray
    tables: int

    def cells(self, vectors: np.ndarray) -> np.ndarray:
        """Places on the lines in cell widths, shape (vectors, tables, lines)."""
        places = (vectors @ self.lines + self.offsets) / self.width
        return places.reshape(len(vectors), self.tables, -1)

    def buckets(self, cells: np.ndarray) -> np.ndarray:
        """One number for the whole cells on a table's lines."""
        return (cells.astype(np.int64) * self.mix).sum(-1)


def fit(sample: np.ndarray, tables: int, lines: int, width: float) -> Hashing:
    rng = np.random.default_rng(SEED)
    dimension = sample.shape[1]
    squares = (sample**2).sum(1)
    near = []
    for row in sample[:: max(1, len(sample) // 200)]:
        apart = np.sqrt(np.maximum(squares - 2 * sample @ row + row @ row, 0))
        near.append(np.sort(apart)[min(10, len(sample) - 1)])
    cell = width * float(np.median(near)) or 1.0
    return Hashing(
        rng.normal(size=(dimension, tables * lines)),
        rng.uniform(0, cell, tables * lines),
        cell,
        rng.integers(1 << 30, 1 << 40, lines) * 2 + 1,
        tables,
    )


def moves(places: np.ndarray, probes: int) -> list[np.ndarray]:
    """The likeliest cell moves of one query in one table, the stay first.

    A move's cost is the sum of squared distances to the borders it crosses;
    sets of moves are visited from the cheapest by growing and shifting.
    """
    inside = places - np.floor(places)
    single = [(gap * gap, line, step) for line, d in enumerate(inside) for gap, step in ((d, -1), (1 - d, 1))]
    single.sort()
    stay = np.zeros(len(places), np.int64)
    found, queue = [stay], [(single[0][0], (0,))]
    while queue and len(found) < probes:
        cost, chosen = heapq.heappop(queue)
        if len({single[i][1] for i in chosen}) == len(chosen):
            move = stay.copy()
            for i in chosen:
                move[single[i][1]] = single[i][2]
            found.append(move)
        following = chosen[-1] + 1
        if following < len(single):
            grown = cost + single[following][0]
            heapq.heappush(queue, (grown, (*chosen, following)))
            heapq.heappush(queue, (grown - single[chosen[-1]][0], (*chosen[:-1], following)))
    return found


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def _vectors(matrix: np.ndarray) -> pa.Array:
    ends = pa.array(np.arange(len(matrix) + 1, dtype=np.int32) * matrix.shape[1])
    return pa.ListArray.from_arrays(ends, pa.array(matrix.ravel()))


def usable(rows: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """Rows (vec_id, vector array<double>) of finite vectors that are not zero."""
    values = F.col(vector).cast("array<double>")
    sound = F.forall(
        "vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    return (
        rows.select(F.col(vec_id).cast("long").alias("vec_id"), values.alias("vector"))
        .where(F.col("vec_id").isNotNull() & F.col("vector").isNotNull())
        .where(sound & F.exists("vector", lambda x: x != 0))
    )


def _classes(rows: DataFrame, members: int) -> DataFrame:
    """Rows (rep, vector, ids): distinct vectors with their smallest ids.

    More ids of one vector than a list of neighbours holds can never be in it,
    because ties go to the smaller id. Tasks cut down to ``members`` ids before
    the shuffle.
    """
    first = F.row_number().over(Window.partitionBy("vector").orderBy("vec_id"))
    few = rows.distinct().withColumn("_n", first).where(F.col("_n") <= members)
    return few.groupBy("vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")).select(
        F.col("ids")[0].alias("rep"), "vector", "ids"
    )


def _index(classes: DataFrame, hashing: Hashing) -> DataFrame:
    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = _matrix(batch.column("vector"))
            buckets = hashing.buckets(np.floor(hashing.cells(vectors)))
            for number in range(hashing.tables):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(vectors), number, np.int32)),
                        pa.array(buckets[:, number]),
                        batch.column("rep"),
                        batch.column("vector"),
                    ],
                    names=["part", "bucket", "id", "vector"],
                )

    return classes.select("rep", "vector").mapInArrow(placed, "part int, bucket long, id long, vector array<double>")


def _probes(queries: DataFrame, hashing: Hashing, probes: int) -> DataFrame:
    def visited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = _matrix(batch.column("vector"))
            cells = hashing.cells(vectors)
            home = np.floor(cells).astype(np.int64)
            for row in range(len(vectors)):
                part, bucket = [], []
                for number in range(hashing.tables):
                    there = home[row, number] + np.array(moves(cells[row, number], probes))
                    bucket.append(hashing.buckets(there))
                    part += [number] * len(there)
                again = pa.array(np.full(len(part), row))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(part, pa.int32()),
                        pa.array(np.concatenate(bucket)),
                        batch.column("rep").take(again),
                        batch.column("vector").take(again),
                    ],
                    names=["part", "bucket", "id", "vector"],
                )

    return queries.mapInArrow(visited, "part int, bucket long, id long, vector array<double>")


def _nearest(index: DataFrame, probes: DataFrame, k: int) -> DataFrame:
    """Rows (query, rep, score): the k best of every bucket block for each query that visits it.

    Blocks' vectors come before the queries of the same block, so a task holds
    one block and the queries of one batch.
    """
    both = index.withColumn("kind", F.lit(0)).unionByName(probes.withColumn("kind", F.lit(1)))
    block = ["part", "bucket", "block"]
    dealt = both.repartition(*block).sortWithinPartitions(*block, "kind")

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids, held = None, [], []
        for batch in batches:
            named = np.stack([batch.column(c).to_numpy() for c in ("part", "bucket", "block", "kind")], 1)
            number, vectors = batch.column("id").to_numpy(), _matrix(batch.column("vector"))
            cuts = np.flatnonzero((named[1:] != named[:-1]).any(1)) + 1
            out = []
            for start, end in zip(np.r_[0, cuts], np.r_[cuts, len(named)]):
                here = tuple(named[start, :3])
                if here != key:
                    key, ids, held = here, [], []
                if named[start, 3] == 0:
                    ids.append(number[start:end])
                    held.append(vectors[start:end])
                elif held:
                    if len(held) > 1:
                        ids, held = [np.concatenate(ids)], [np.concatenate(held)]
                    for row in range(start, end):
                        apart = np.sqrt(((held[0] - vectors[row]) ** 2).sum(1))
                        best = np.arange(len(apart))
                        if len(apart) > k:
                            worst = np.partition(apart, k - 1)[k - 1]
                            best = np.flatnonzero(apart <= worst)
                        best = best[np.lexsort((ids[0][best], apart[best]))][:k]
                        out.append((np.full(len(best), number[row]), ids[0][best], apart[best]))
            if out:
                columns = [pa.array(np.concatenate(c)) for c in zip(*out)]
                yield pa.RecordBatch.from_arrays(columns, names=["query", "rep", "score"])

    return dealt.select(*block, "kind", "id", "vector").mapInArrow(compared, "query long, rep long, score double")


def _blocked(index: DataFrame, probes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides with the block of their bucket; queries go to each block of a large one."""
    large = (
        index.groupBy("part", "bucket")
        .agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
        .where("blocks > 1")
    )
    large = staged(large, "ann-large-buckets")
    block = F.pmod(F.xxhash64("id"), F.coalesce("blocks", F.lit(1))).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1))
    keys = ["part", "bucket"]
    return (
        index.join(large, keys, "left").withColumn("block", block).drop("blocks"),
        probes.join(large, keys, "left").withColumn("block", every).drop("blocks"),
    )


def _best(found: DataFrame, classes: DataFrame, k: int) -> DataFrame:
    """Rows (query, vec_id, score): the k nearest ids of each query, equal vectors spread out."""
    near = Window.partitionBy("query").orderBy("score", "rep")
    few = found.groupBy("query", "rep").agg(F.min("score").alias("score"))
    few = few.withColumn("_n", F.row_number().over(near)).where(F.col("_n") <= k)
    spread = few.join(classes.select("rep", "ids"), "rep").select("query", "score", F.explode("ids").alias("vec_id"))
    ordered = Window.partitionBy("query").orderBy("score", "vec_id")
    return spread.withColumn("_n", F.row_number().over(ordered)).where(F.col("_n") <= k).drop("_n")


def search(
    rows: DataFrame,
    is_query,
    k: int = 10,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    tables: int = TABLES,
    lines: int = LINES,
    probes: int = PROBES,
    width: float = WIDTH,
) -> DataFrame:
    """Rows (query_id, rank, vec_id, score): the k nearest found of every query but itself.

    ``is_query`` tells from the column ``vec_id`` which rows are queries.
    """
    sound = usable(rows, vec_id, vector)
    # The length that most of all rows have, of equally frequent ones the smallest.
    lengths = sound.groupBy(F.size("vector").alias("size")).agg(F.count(F.lit(1)).alias("rows"))
    commonest = lengths.orderBy(F.col("rows").desc(), "size").first()
    dimension = commonest["size"] if commonest else 1
    sound = sound.where(F.size("vector") == dimension)
    drawn = [r["vector"] for r in sound.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).collect()]
    hashing = fit(np.array(drawn or [[0.0] * dimension]), tables, lines, width)

    # One more than asked for: a query finds itself.
    classes = staged(_classes(sound, k + 1), "ann-classes")
    asked = sound.where(is_query(F.col("vec_id")))
    searched = staged(
        asked.select("vector").distinct().join(classes.select("vector", "rep"), "vector"), "ann-queries"
    )
    index = _index(classes, hashing)
    visits = _probes(searched.select("rep", "vector"), hashing, probes)
    found = staged(_nearest(*_blocked(index, visits), k + 1), "ann-found")

    # Queries whose buckets hold too few vectors are compared with every block of all.
    enough = found.groupBy("query").agg(F.count_distinct("rep").alias("n")).where(F.col("n") > k)
    lacking = searched.join(enough, searched["rep"] == enough["query"], "left_anti")
    lacking = staged(lacking.select("rep", "vector"), "ann-lacking")
    if not lacking.isEmpty():
        blocks = max(1, -(-classes.count() // BLOCK))
        whole = classes.select(
            F.lit(-1).alias("part"),
            F.lit(0).cast("long").alias("bucket"),
            F.col("rep").alias("id"),
            "vector",
            F.pmod(F.xxhash64("rep"), F.lit(blocks)).cast("int").alias("block"),
        )
        everywhere = lacking.select(
            F.lit(-1).alias("part"),
            F.lit(0).cast("long").alias("bucket"),
            F.col("rep").alias("id"),
            "vector",
            F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"),
        )
        found = found.unionByName(_nearest(whole, everywhere, k + 1))
    best = _best(found, classes, k + 1)
    named = asked.join(searched.select("vector", F.col("rep").alias("query")), "vector").select(
        F.col("vec_id").alias("query_id"), "query"
    )
    ranks = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (
        named.distinct()
        .join(best, "query")
        .where(F.col("vec_id") != F.col("query_id"))
        .withColumn("rank", F.row_number().over(ranks))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
