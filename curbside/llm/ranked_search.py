"""Ranked lexical search by pipelined term partitioning.

Terms are dealt to owners, those of greatest weight to the first. A document's
postings lie in its shard, a bounded number of documents that meet by a hash, cut
by owner. Every shard has a bundle of the items with sparse accumulators, from
documents to integer scores. The bundle passes the owners one after another: in
each stage a cogroup brings it together with the postings of that owner's terms,
whose contributions are added. After the last owner the best documents of each
shard are merged into the final ranking.

Nothing is cut off but what cannot win: an accumulator stays while its score and
the greatest contributions of all later owners together reach the score of rank
``TOP`` in the shard. Every contribution is a 64-bit integer, so no order of
addition matters.

Items are taken in passes whose vocabulary is bounded; more items mean more passes
over the documents, not more memory.

Defined results: terms are matched whole, A-Z lower-cased; a NULL text has none,
and an item without terms that documents hold gets no rows. Documents without a
term count for nothing; without an id they count in the statistics and are not
returned. Repeated rows are documents of their own and may share an item's ranks;
rows of one item id are one item with all their terms, and items without an id are
left out. An empty table on either side gives an empty result. Other columns are
not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from curbside.llm.text import small_batches
from curbside.workspace import staged

TOP = 50
OWNERS = 4
SHARD_DOCUMENTS = 4_096
# Bytes of item terms, and items, that one pass over the documents takes.
PASS_BYTES = 32 << 20
PASS_ITEMS = 2_000
# Parts in which an item's candidates are cut down before they meet.
MERGE_PARTS = 32

# Fixed value: ASCII letters and digits and all other code points make terms; A-Z become a-z.
TERM_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(TERM_BYTES).split()


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def _item_terms(items: DataFrame) -> DataFrame:
    """Distinct rows (item_id, term) of items (item_id, text)."""

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, terms = [], []
            for item, text in zip(batch.column("item_id").to_pylist(), batch.column("text").to_pylist()):
                own = set(terms_of((text or "").encode()))
                ids += [item] * len(own)
                terms += own
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(terms, pa.binary())], names=["item_id", "term"]
            )

    return items.where("item_id IS NOT NULL").mapInArrow(listed, "item_id long, term binary").distinct()


def _term_counts(docs: DataFrame, numbers) -> DataFrame:
    """Rows (doc_id, n, terms, tfs): all terms counted, those with a number listed, of documents with any."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = numbers.value.get
        for batch in small_batches(batches, "text"):
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            rows, lengths, ends, terms, tfs = [], [], [0], [], []
            for row, text in enumerate(texts):
                listed = terms_of(text or b"")
                if not listed:
                    continue
                found = Counter(map(number, listed))
                found.pop(None, None)
                rows.append(row)
                lengths.append(len(listed))
                terms += found.keys()
                tfs += found.values()
                ends.append(len(terms))
            ends = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(rows, pa.int64())),
                    pa.array(lengths, pa.int64()),
                    pa.ListArray.from_arrays(ends, pa.array(terms, pa.int32())),
                    pa.ListArray.from_arrays(ends, pa.array(tfs, pa.int32())),
                ],
                names=["doc_id", "n", "terms", "tfs"],
            )

    return docs.mapInArrow(counted, "doc_id long, n long, terms array<int>, tfs array<int>")


def _owned(postings: DataFrame, owners: np.ndarray, owner: int) -> DataFrame:
    """Rows (shard, row, doc_id, m, terms, tfs) with one owner's terms only."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms, tfs = batch.column("terms"), batch.column("tfs")
            flat = terms.flatten().to_numpy(False)
            mine = owners[flat] == owner
            lengths = np.diff(terms.offsets.to_numpy())
            kept = np.bincount(np.repeat(np.arange(len(lengths)), lengths)[mine], minlength=len(lengths))
            held = np.flatnonzero(kept)
            ends = pa.array(np.append(0, np.cumsum(kept[held])), pa.int32())
            named = [batch.column(c).take(pa.array(held)) for c in ("shard", "row", "doc_id", "m")]
            lists = [
                pa.ListArray.from_arrays(ends, pa.array(cells[mine], pa.int32()))
                for cells in (flat, tfs.flatten().to_numpy(False))
            ]
            yield pa.RecordBatch.from_arrays(named + lists, names=["shard", "row", "doc_id", "m", "terms", "tfs"])

    return postings.mapInArrow(cut, "shard long, row long, doc_id long, m long, terms array<int>, tfs array<int>")


def _flat(table: pa.Table, column: str) -> np.ndarray:
    return table.column(column).combine_chunks().flatten().to_numpy(False)


def _lengths(table: pa.Table, column: str) -> np.ndarray:
    return np.diff(table.column(column).combine_chunks().offsets.to_numpy())


class Shard:
    """A bundle's accumulators and one owner's postings, over the same documents."""

    def __init__(self, bundle: pa.Table, postings: pa.Table):
        bundle = bundle.sort_by("item")
        own, carried = postings.column("row").to_numpy(), _flat(bundle, "rows")
        self.rows, first = np.unique(np.append(own, carried), return_index=True)
        self.docs = np.append(postings.column("doc_id").to_numpy(), _flat(bundle, "docs"))[first]
        self.scores = np.zeros(len(self.rows), np.int64)
        # Postings by term, with the part of a contribution that all items share.
        lengths = _lengths(postings, "terms")
        terms, tfs = _flat(postings, "terms"), _flat(postings, "tfs").astype(np.int64)
        m = np.repeat(postings.column("m").to_numpy(), lengths)
        share = (1_000_000_000 * tfs) // (1_000 * tfs + 20 * m)
        order = np.argsort(terms, kind="stable")
        self.terms, self.share = terms[order], share[order]
        self.places = np.repeat(np.searchsorted(self.rows, own), lengths)[order]
        # Accumulators by item.
        items, ends = bundle.column("item").to_pylist(), np.append(0, np.cumsum(_lengths(bundle, "rows")))
        at, sums = np.searchsorted(self.rows, carried), _flat(bundle, "scores")
        self.carried = {i: (at[a:b], sums[a:b]) for i, a, b in zip(items, ends[:-1].tolist(), ends[1:].tolist())}

    def accumulate(self, item: int, terms: np.ndarray, weights: list[int]) -> np.ndarray:
        """Add one item's contributions to what its bundle carries; places of documents with a score."""
        at, sums = self.carried.get(item, (slice(0), 0))
        self.scores[at] = sums
        starts, ends = np.searchsorted(self.terms, terms), np.searchsorted(self.terms, terms, "right")
        for a, b, w in zip(starts.tolist(), ends.tolist(), weights):
            self.scores[self.places[a:b]] += w * self.share[a:b]
        return np.flatnonzero(self.scores)

    def still_possible(self, found: np.ndarray, rest: int, top: int) -> np.ndarray:
        """Of the places found, those that later contributions of up to ``rest`` may bring to the top."""
        if len(found) <= top:
            return found
        sums = self.scores[found]
        return found[sums + rest >= np.partition(sums, -top)[-top]]

    def best(self, found: np.ndarray, top: int) -> np.ndarray:
        return found[np.lexsort((self.docs[found], -self.scores[found]))[:top]]


_BUNDLE = "shard long, item int, rows array<long>, docs array<long>, scores array<long>"
_RANKED = "shard long, item int, doc_id long, score long"


def _stage(bundles: DataFrame, postings: DataFrame, queries: list, top: int, last: bool) -> DataFrame:
    """One owner adds its contributions; ``queries`` holds (item, terms, weights, rest) of all items."""

    def passed(bundle: pa.Table, owned: pa.Table) -> pa.Table:
        shard = Shard(bundle, owned)
        number = (owned if owned.num_rows else bundle).column("shard")[0].as_py()
        items, lengths, parts = [], [], []
        for item, terms, weights, rest in queries:
            if not len(terms) and item not in shard.carried:
                continue
            found = shard.accumulate(item, terms, weights)
            if len(found):
                kept = shard.best(found, top) if last else shard.still_possible(found, rest, top)
                items.append(item)
                lengths.append(len(kept))
                parts.append((shard.rows[kept], shard.docs[kept], shard.scores[kept]))
                shard.scores[found] = 0
        rows, docs, scores = (np.concatenate(p) for p in zip(*parts)) if parts else [np.zeros(0, np.int64)] * 3
        if last:
            of = np.repeat(np.array(items, np.int32), lengths)
            shards = np.full(len(of), number, np.int64)
            return pa.Table.from_arrays(list(map(pa.array, (shards, of, docs, scores))), ["shard", "item", "doc_id", "score"])
        ends = pa.array(np.append(0, np.cumsum(lengths)), pa.int32())
        lists = [pa.ListArray.from_arrays(ends, pa.array(v)) for v in (rows, docs, scores)]
        named = [pa.array([number] * len(items), pa.int64()), pa.array(items, pa.int32())]
        return pa.Table.from_arrays(named + lists, ["shard", "item", "rows", "docs", "scores"])

    paired = bundles.groupBy("shard").cogroup(postings.groupBy("shard"))
    return paired.applyInArrow(passed, _RANKED if last else _BUNDLE)


def _cut_by_postings(weights: np.ndarray, holding: np.ndarray, owners: int) -> np.ndarray:
    """Owner of each term: by falling weight, with about as many postings each."""
    order = np.lexsort((np.arange(len(weights)), -weights))
    before = np.cumsum(holding[order]) - holding[order]
    owner = np.zeros(len(weights), np.int64)
    owner[order] = before * owners // max(1, int(holding.sum()))
    return owner


def _pass(docs: DataFrame, queries: list[tuple[int, list[bytes]]], top: int) -> DataFrame | None:
    """Rows (item_id, rank, doc_id, score) of the items of one pass."""
    spark = docs.sparkSession
    vocabulary = sorted(set(chain.from_iterable(terms for _, terms in queries)))
    number = {term: i for i, term in enumerate(vocabulary)}
    # Bounded by PASS_BYTES.
    counted = _term_counts(docs, spark.sparkContext.broadcast(number))
    # The number of a row is written, so it stays when a task runs again.
    counted = staged(counted.withColumn("row", F.monotonically_increasing_id()), "search-terms")
    total = counted.agg(F.count(F.lit(1)).alias("documents"), F.sum("n").alias("terms")).first()
    if not total["documents"]:
        return None
    m = F.expr(f"100 - 50 + (50 * n * {total['documents']}L) div {total['terms']}L")
    shards = -(-total["documents"] // SHARD_DOCUMENTS)
    counted = counted.withColumns({"m": m, "shard": F.pmod(F.xxhash64("row"), F.lit(shards))})

    pairs = counted.select("m", F.explode(F.arrays_zip("terms", "tfs")).alias("p"))
    share = F.expr("(1000000000L * p.tfs) div (1000L * p.tfs + 20L * m)")
    # One row per term of the pass.
    held = pairs.groupBy(F.col("p.terms").alias("term")).agg(F.count(F.lit(1)).alias("df"), F.max(share).alias("most"))
    holding, most = np.zeros(len(vocabulary), np.int64), np.zeros(len(vocabulary), np.int64)
    for row in held.collect():
        holding[row["term"]], most[row["term"]] = row["df"], row["most"]
    weights = np.array([weight(total["documents"], int(df)) if df else 0 for df in holding], np.int64)
    owners = _cut_by_postings(weights, holding, OWNERS)

    named = counted.where("doc_id IS NOT NULL AND size(terms) > 0").select("shard", "row", "doc_id", "m", "terms", "tfs")
    terms_by_item = [np.array([number[t] for t in terms], np.int64) for _, terms in queries]
    bundles = spark.createDataFrame([], _BUNDLE)
    for owner in range(OWNERS):
        stage = []
        for item, terms in enumerate(terms_by_item):
            mine, later = terms[owners[terms] == owner], terms[owners[terms] > owner]
            stage.append((item, mine, weights[mine].tolist(), int((weights[later] * most[later]).sum())))
        bundles = _stage(bundles, _owned(named, owners, owner), stage, top, owner == OWNERS - 1)

    order = [F.col("score").desc(), F.col("doc_id")]
    part = F.pmod(F.col("shard"), F.lit(MERGE_PARTS))
    near = F.row_number().over(Window.partitionBy("item", "part").orderBy(*order))
    merged = bundles.withColumn("part", part).withColumn("near", near).where(F.col("near") <= top)
    ranked = merged.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order)))
    ids = spark.createDataFrame([(i, item) for i, (item, _) in enumerate(queries)], "item int, item_id long")
    best = ranked.where(F.col("rank") <= top)
    return best.join(F.broadcast(ids), "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """Rows (item_id, rank, doc_id, score): the best documents (doc_id, text) of each item (item_id, text)."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    items = items.select(F.col("item_id").cast("long").alias("item_id"), "text")
    asked = staged(_item_terms(items), "search-items")
    size = asked.agg(F.sum(F.octet_length("term") + 16).alias("bytes"), F.count_distinct("item_id").alias("items")).first()
    passes = max(1, -(-(size["bytes"] or 0) // PASS_BYTES), -(-size["items"] // PASS_ITEMS))
    results = []
    for number in range(passes):
        chosen = asked.where(F.pmod(F.xxhash64("item_id"), F.lit(passes)) == number)
        grouped = chosen.groupBy("item_id").agg(F.collect_list("term").alias("terms"))
        # About PASS_BYTES.
        queries = [(r["item_id"], sorted(map(bytes, r["terms"]))) for r in grouped.orderBy("item_id").collect()]
        if queries and (found := _pass(docs, queries, top)) is not None:
            results.append(found)
    if not results:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return reduce(DataFrame.unionByName, results)


_SQL_TERMS = (
    "regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
)
SQL = f"""with texts as (select row_number() over () as line, doc_id, {_SQL_TERMS} as terms from documents),
  lengths as (select line, doc_id, len(terms) as n from texts where len(terms) > 0),
  counts as (select line, term, count(*) as tf from (select line, unnest(terms) as term from texts) group by all),
  total as (select count(*) as documents, cast(sum(n) as bigint) as words from lengths),
  asked as (select distinct item_id, unnest({_SQL_TERMS}) as term from benchmark),
  weights as (
    select term, cast(floor(1000 * ln((2 * documents + 2) / cast(2 * count(*) + 1 as double))) as bigint) as w
    from counts cross join total where term in (select term from asked) group by term, documents),
  scored as (
    select item_id, line, doc_id,
      cast(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * documents) // words)))) as bigint) as score
    from asked join weights using (term) join counts using (term) join lengths using (line) cross join total
    where doc_id is not null and item_id is not null group by all)
  select item_id, cast(row_number() over (partition by item_id order by score desc, doc_id) as int) as rank, doc_id, score
  from scored where score > 0 qualify rank <= {TOP}"""
