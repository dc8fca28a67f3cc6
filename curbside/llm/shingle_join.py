"""Similarity join of documents on word shingles, by vertical partitioning.

Two documents link when the Jaccard similarity of their shingle sets reaches
``PERCENT``. The global order of shingles is cut into fragments; a pair's overlap
is counted in each fragment by itself and the counts are summed per pair.

Before that, documents without any possible partner and pairs without any
possible link are left out, by bounds that lose no link:

1. Equal sets are joined as one, named by a 64-bit signature of the set.
2. A document that links keeps at least 75 % of its shingles in common with its
   partner. So of its ``HEAD`` percent smallest shingles (by hash) a known
   number is also in the partner's head. Heads alone are counted, and documents
   with too few shingles in other heads drop out.
3. The remaining documents' whole sets are counted. In the order of rising
   frequency, two linked documents share one of the first shingles of their sets,
   up to a bound. Every such shingle carries how many shared shingles the set has
   from there on. At the first shingle of a pair both have at least as many left as
   their overlap must have, which their sizes tell; so a set that is mostly a common
   passage, but not enough of it, pairs with none of the passage's other holders.
4. For every shingle the document with most left is compared with the others,
   ``ROUNDS`` times. Documents so linked form components, and pairs inside one need
   no comparison: a group of thousands of near copies costs a few comparisons per
   copy.
5. Of what is left, a document stays by a shingle while another component has a
   document there whose bound reaches its size. Pairs between components are
   compared, each made once however many shingles it shares.

Shingles are 64-bit hashes of five words.

Defined results: a text with fewer words than a shingle is one shingle; without
words, or NULL, the set is empty and links with nothing; repeated rows are each
returned; rows of one id with different texts are one document with the links of
them all, where its texts have words; a NULL id links with nothing and is its own
component. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from curbside.llm.components import components
from curbside.llm.text import map_texts, small_batches
from curbside.operators.joins import lookup_join
from curbside.workspace import staged

WORDS = 5
PERCENT = 75
# Percentage of a set's shingles, smallest hashes first, that form its head.
HEAD = 40
FRAGMENTS = 8
ROUNDS = 2
# Bytes of text that a task hashes at a time.
PART_BYTES = 2 << 20

_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[ord("A") : ord("Z") + 1] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _mix(values: np.ndarray) -> np.ndarray:
    """A fixed permutation of 64-bit numbers that scatters their bits."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and where each text's words begin (one entry more than texts)."""
    whole = texts.fill_null("").cast(pa.large_binary())
    ends = np.frombuffer(whole.buffers()[1], np.int64)[whole.offset : whole.offset + len(whole) + 1]
    held = whole.buffers()[2]
    data = np.frombuffer(held, np.uint8)[ends[0] : ends[-1]] if held is not None else np.zeros(0, np.uint8)
    ends = ends - ends[0]
    inside = ~_SPACE[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    inner = ends[1:-1][ends[1:-1] < len(data)]
    begins[inner] |= inside[inner]
    first = np.flatnonzero(begins)
    if not len(first):
        return np.zeros(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    place = np.arange(len(data))
    place[first[0] :] -= np.repeat(first, np.diff(np.append(first, len(data))))
    powers = np.cumprod(np.full(int(place[inside].max()) + 1, _BASE, np.uint64))
    coded = np.zeros(len(data), np.uint64)
    coded[inside] = (_LOWER[data[inside]] + np.uint64(1)) * powers[place[inside]]
    return _mix(np.add.reduceat(coded, first)), np.searchsorted(first, ends)


def shingle_sets(texts: pa.Array, words: int = WORDS) -> list[np.ndarray]:
    """Each text's distinct shingles, ascending."""
    hashes, starts = word_hashes(texts)
    weights = np.cumprod(np.full(words, _BASE | np.uint64(2), np.uint64))
    runs = np.zeros(len(hashes), np.uint64)
    if len(hashes) >= words:
        count = len(hashes) - words + 1
        for step in range(words):
            runs[:count] += hashes[step : step + count] * weights[step]
    runs = _mix(runs)
    sets = []
    for start, end in zip(starts[:-1].tolist(), starts[1:].tolist()):
        if end - start >= words:
            sets.append(np.unique(runs[start : end - words + 1]))
        else:
            few = hashes[start:end]
            whole = (few * weights[: len(few)]).sum(dtype=np.uint64) + np.uint64(len(few))
            sets.append(_mix(np.array([whole], np.uint64))[: len(few)])
    return sets


def _head_size(n: int) -> int:
    """Of n shingles, how many make the head: ``HEAD`` percent, and one more than may be missing."""
    missing = n - -(-PERCENT * n // 100)
    return min(n, max(-(-HEAD * n // 100), missing + 1))


def _shared_at_least(n: Column) -> Column:
    """How many shingles of a head of a set of n are in the head of any linked set.

    The pair's head that ends at the smaller hash misses at most 25 % of its
    set, and its set has at least 75 % of the other's size.
    """
    return F.greatest(F.lit(1), F.ceil(n * ((HEAD - (100 - PERCENT)) * PERCENT) / F.lit(10_000)))


def set_name(shingles: np.ndarray) -> int:
    """64 bits that name a set, whatever the order of its shingles."""
    sums = _mix(shingles).sum(dtype=np.uint64), _mix(shingles ^ _BASE).sum(dtype=np.uint64)
    mixed = _mix(np.array([sums[0]], np.uint64) ^ _mix(np.array([sums[1]], np.uint64) + np.uint64(len(shingles))))
    return int(mixed.view(np.int64)[0])


def _signatures(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, n, doc): set size and the set's name."""

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text", PART_BYTES):
            sets = shingle_sets(batch.column("text"))
            sizes, names = [len(s) for s in sets], [set_name(s) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(names, pa.int64())],
                names=["doc_id", "n", "doc"],
            )

    return map_texts(docs, signed, "doc_id long, n long, doc long")


def _heads(docs: DataFrame) -> DataFrame:
    """Rows (shingle, doc, others): the sets of a batch with this shingle in their head, equal ones once."""

    def headed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text", PART_BYTES):
            named: dict[int, np.ndarray] = {}
            for doc, s in zip(batch.column("doc_id").to_pylist(), shingle_sets(batch.column("text"))):
                if len(s) and doc is not None:
                    named[set_name(s)] = s[: _head_size(len(s))]
            if not named:
                continue
            shingles = np.concatenate(list(named.values()))
            owner = np.repeat(list(named), [len(h) for h in named.values()])
            order = np.argsort(shingles, kind="stable")
            shingles, owner = shingles[order], owner[order].astype(np.int64)
            first = np.flatnonzero(np.r_[True, shingles[1:] != shingles[:-1]])
            rest = np.ones(len(owner), bool)
            rest[first] = False
            sizes = np.diff(np.append(first, len(owner))) - 1
            ends = np.append(0, np.cumsum(sizes)).astype(np.int32)
            others = pa.ListArray.from_arrays(
                pa.array(ends), pa.array(owner[rest]), mask=pa.array(sizes == 0)
            )
            yield pa.RecordBatch.from_arrays(
                [pa.array(shingles[first].view(np.int64)), pa.array(owner[first]), others],
                names=["shingle", "doc", "others"],
            )

    return map_texts(docs, headed, "shingle long, doc long, others array<long>")


def _segments(docs: DataFrame) -> DataFrame:
    """Rows (doc, fragment, shingles): each set cut at fixed places of the global order."""
    shift = np.uint64(64 - (FRAGMENTS - 1).bit_length())

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text", PART_BYTES):
            doc, fragment, ends, parts = [], [], [0], []
            for s in shingle_sets(batch.column("text")):
                number = set_name(s)
                at = np.searchsorted(s >> shift, np.arange(FRAGMENTS + 1, dtype=np.uint64))
                for f in range(FRAGMENTS):
                    if at[f] < at[f + 1]:
                        doc.append(number)
                        fragment.append(f)
                        parts.append(s[at[f] : at[f + 1]])
                        ends.append(ends[-1] + len(parts[-1]))
            flat = np.concatenate(parts).view(np.int64) if parts else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(doc, pa.int64()),
                    pa.array(fragment, pa.int32()),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat)),
                ],
                names=["doc", "fragment", "shingles"],
            )

    return map_texts(docs, cut, "doc long, fragment int, shingles array<long>")


def _postings(heads: DataFrame, sets: DataFrame) -> DataFrame:
    """Rows (shingle, doc, n): the shingles by which heads can meet, of documents with enough.

    ``sets`` holds (doc, n) of every set.
    """
    holders = 1 + F.coalesce(F.size("others"), F.lit(0))
    counted = heads.withColumn("frequency", F.sum(holders).over(Window.partitionBy("shingle")))
    every = F.concat(F.array("doc"), F.coalesce("others", F.array().cast("array<long>")))
    shared = counted.where("frequency > 1").select("shingle", "frequency", F.explode(every).alias("doc"))
    return _first_shared(shared, sets, _shared_at_least(F.col("n")))


def _first_shared(shared: DataFrame, sets: DataFrame, least: Column) -> DataFrame:
    """Rows (shingle, doc, n, left): the first shingles of each list, of rising frequency.

    ``shared`` holds (shingle, frequency, doc) of the shingles that several
    documents have. Linked lists have ``least`` in common. Shingles of one
    document alone come first in the order, so a list of s shared shingles meets a
    linked one within its first s - least + 1 shared ones. ``left`` counts the shared
    shingles from each one on.
    """
    # A list is at most as long as its text; a set read in several batches lists a shingle once.
    listed = shared.groupBy("doc").agg(F.collect_set(F.struct("frequency", "shingle")).alias("shared"))
    reach = (F.size("shared") - least + 1).cast("int")
    kept = lookup_join(listed, sets, ["doc"]).withColumn("reach", reach).where("reach > 0")
    first = F.slice(F.sort_array("shared"), 1, F.col("reach"))
    placed = kept.select(F.posexplode(first).alias("place", "s"), "doc", "n", F.size("shared").alias("size"))
    return placed.select("s.shingle", "doc", "n", (F.col("size") - F.col("place")).cast("long").alias("left"))


def _whole_postings(segments: DataFrame, sets: DataFrame) -> DataFrame:
    """The same of whole sets."""
    every = segments.select("doc", F.explode("shingles").alias("shingle"))
    frequent = every.groupBy("shingle").agg(F.count(F.lit(1)).alias("frequency")).where("frequency > 1")
    least = F.ceil(F.col("n") * PERCENT / 100)
    return _first_shared(every.join(frequent, "shingle"), sets, least)


def _partnered(postings: DataFrame) -> DataFrame:
    """Without the shingles that only one document is left with."""
    several = postings.groupBy("shingle").agg(F.min("doc").alias("lo"), F.max("doc").alias("hi")).where("lo < hi")
    return postings.join(several.select("shingle"), "shingle")


def _largest_partner(n: str, left: str) -> Column:
    """Size of the largest set that can overlap enough where ``left`` shared shingles are left.

    100 overlap >= PERCENT (n + m - overlap), with overlap at most left.
    """
    return F.floor(F.col(left) * (100 + PERCENT) / F.lit(PERCENT)) - F.col(n)


def _may_link(a: str, b: str) -> Column:
    """Whether postings (n, most) of one shingle, with these prefixes, may belong to a linked pair."""
    return (F.col(f"{a}n") <= F.col(f"{b}most")) & (F.col(f"{b}n") <= F.col(f"{a}most"))


def _linked(pairs: DataFrame, segments: DataFrame) -> DataFrame:
    """The pairs (a, b, na, nb) that link: overlaps counted by fragment and summed."""
    left = segments.select(F.col("doc").alias("a"), "fragment", F.col("shingles").alias("mine"))
    right = segments.select(F.col("doc").alias("b"), "fragment", F.col("shingles").alias("theirs"))
    partial = F.size(F.array_intersect("mine", "theirs")).cast("long")
    overlap = (
        pairs.join(left, "a")
        .join(right, ["b", "fragment"])
        .select("a", "b", "na", "nb", partial.alias("partial"))
        .groupBy("a", "b", "na", "nb")
        .agg(F.sum("partial").alias("overlap"))
    )
    union = F.col("na") + F.col("nb") - F.col("overlap")
    return overlap.where(100 * F.col("overlap") >= PERCENT * union).select("a", "b")


def _pivot_pairs(postings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pairs of each shingle's pivot with its others, and the postings without the pivots.

    The pivot is the document with most shingles left, say a group's original. Only
    documents of different components are paired.
    """
    order = F.struct(F.col("left"), F.bitwise_not("doc").alias("last"), F.col("doc"), F.col("n"), F.col("most"), F.col("root"))
    pivots = postings.groupBy("shingle").agg(F.max(order).alias("p"), F.min("root").alias("lo"), F.max("root").alias("hi"))
    pivots = pivots.where("lo < hi").select("shingle", *[F.col(f"p.{c}").alias(f"p_{c}") for c in ("doc", "n", "most", "root")])
    rest = postings.join(pivots, "shingle").where(F.col("doc") != F.col("p_doc"))
    pairs = rest.where((F.col("root") != F.col("p_root")) & _may_link("", "p_"))
    return _distinct_pairs(pairs, "doc", "n", "p_doc", "p_n"), rest.select("shingle", "doc", "n", "left", "most")


def _distinct_pairs(pairs: DataFrame, a: str, na: str, b: str, nb: str) -> DataFrame:
    low = F.col(a) < F.col(b)
    sides = [F.when(low, F.col(x)).otherwise(F.col(y)) for x, y in ((a, b), (b, a), (na, nb), (nb, na))]
    return pairs.select(*[side.alias(name) for side, name in zip(sides, ("a", "b", "na", "nb"))]).distinct()


def _still_open(postings: DataFrame) -> DataFrame:
    """Postings of documents that a document of another component may reach by the same shingle."""
    best = postings.groupBy("shingle", "root").agg(F.max("most").alias("most"))
    top = best.groupBy("shingle").agg(F.max(F.struct("most", "root")).alias("top"))
    others = best.join(top, "shingle").where(F.col("root") != F.col("top.root"))
    second = others.groupBy("shingle").agg(F.max("most").alias("second"))
    reached = top.join(second, "shingle")
    other = F.when(F.col("root") == F.col("top.root"), F.col("second")).otherwise(F.col("top.most"))
    return postings.join(reached, "shingle").where(F.col("n") <= other).select(*postings.columns)


def _rooted(postings: DataFrame, roots: DataFrame) -> DataFrame:
    return postings.join(roots.select("doc", "root"), "doc")


def _open_pairs(postings: DataFrame) -> DataFrame:
    """All pairs between components that may link by a shingle both have; each once."""
    a, b = (
        postings.select("shingle", *[F.col(c).alias(f"{side}_{c}") for c in ("doc", "n", "most", "root")])
        for side in ("a", "b")
    )
    between = (F.col("a_root") < F.col("b_root")) & _may_link("a_", "b_")
    met = a.join(b, (a["shingle"] == b["shingle"]) & between)
    return _distinct_pairs(met, "a_doc", "a_n", "b_doc", "b_n")


def _joined(roots: DataFrame, links: DataFrame) -> DataFrame:
    """Roots (doc, n, root) after the components of linked documents are joined."""
    a = roots.select(F.col("doc").alias("a"), F.col("root").alias("ra"))
    b = roots.select(F.col("doc").alias("b"), F.col("root").alias("rb"))
    between = links.join(a, "a").join(b, "b").where("ra != rb").select(F.col("ra").alias("a"), F.col("rb").alias("b"))
    moved = components(between).select(F.col("node").alias("root"), F.col("root").alias("top"))
    return roots.join(moved, "root", "left").select("doc", "n", F.coalesce("top", "root").alias("root"))


def _one_document(signed: DataFrame) -> DataFrame:
    """Links (a, b) between the different sets of one id."""
    several = signed.groupBy("doc_id").agg(F.min("doc").alias("a"), F.max("doc").alias("b")).where("a < b")
    return signed.join(several.select("doc_id", "a"), "doc_id").where("a < doc").select("a", F.col("doc").alias("b")).distinct()


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (doc_id, n_shingles, component_id), one per document.

    ``component_id`` is the smallest id reachable by links.
    """
    whole = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    signed = staged(_signatures(whole), "shingle-signatures")
    named = signed.where("n > 0 AND doc_id IS NOT NULL")
    classes = staged(named.groupBy("doc").agg(F.max("n").alias("n"), F.min("doc_id").alias("doc_id")), "shingle-classes")
    sets = classes.select("doc", "n")
    heads = staged(_partnered(_postings(_heads(whole), sets)).select("doc").distinct(), "shingle-heads")
    # The texts of the smallest ids of the sets in question; an id may have other texts besides.
    asked = lookup_join(classes, heads, ["doc"], "left_semi").select("doc_id")
    texts = lookup_join(whole, asked.distinct(), ["doc_id"], "left_semi")
    segments = lookup_join(_segments(texts), heads, ["doc"], "left_semi").dropDuplicates(["doc", "fragment"])
    segments = staged(segments, "shingle-segments")
    postings = _partnered(_whole_postings(segments, sets)).withColumn("most", _largest_partner("n", "left"))
    postings = staged(postings, "shingle-postings")

    same = staged(_one_document(named), "shingle-same-id")
    nodes = postings.select("doc").unionByName(same.select(F.col("a").alias("doc"))).unionByName(same.select(F.col("b").alias("doc")))
    roots = staged(lookup_join(sets, nodes.distinct(), ["doc"], "left_semi").withColumn("root", F.col("doc")), "shingle-roots")
    if not same.isEmpty():
        roots = staged(_joined(roots, same), "shingle-roots")
    for number in range(ROUNDS + 1):
        rooted = _rooted(postings, roots)
        pairs, postings = _pivot_pairs(rooted) if number < ROUNDS else (_open_pairs(rooted), postings)
        links = staged(_linked(staged(pairs, "shingle-pairs"), segments), "shingle-links")
        if not links.isEmpty():
            roots = staged(_joined(roots, links), "shingle-roots")
        if number < ROUNDS:
            postings = staged(_still_open(_rooted(postings, roots)).drop("root"), "shingle-postings")
            if postings.isEmpty():
                break

    # A component is named by the smallest id among all its sets' documents.
    of_class = lookup_join(classes, roots.select("doc", "root"), ["doc"], "left").withColumn("root", F.coalesce("root", "doc"))
    least = of_class.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    of_class = of_class.join(least, "root").select("doc", "component_id")
    keyed = signed.join(of_class, "doc", "left")
    linked = F.col("doc_id").isNotNull() & (F.col("n") > 0)
    return keyed.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(linked, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
    )


def keep_first_of_each_group(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each component: the one of smallest id; columns as given.

    Rows repeated with one id are copies too, and the one of smallest text stays.
    Documents without an id stay. Only texts with a repeated id are shuffled.
    """
    groups = near_duplicates(docs, doc_id, text).where(F.col("doc_id") == F.col("component_id"))
    stays = staged(groups.groupBy(F.col("doc_id").alias(doc_id)).agg(F.count(F.lit(1)).alias("rows")), "shingle-kept")
    once = lookup_join(docs, stays.where("rows = 1").select(doc_id), [doc_id], "left_semi")
    again = lookup_join(docs, stays.where("rows > 1").select(doc_id), [doc_id], "left_semi")
    nameless = docs.where(F.col(doc_id).isNull())
    first = F.row_number().over(Window.partitionBy(doc_id).orderBy(text))
    again = again.withColumn("_first", first).where("_first = 1").drop("_first")
    return once.unionByName(again).unionByName(nameless)
