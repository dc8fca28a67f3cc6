"""Removal of long repeated strings by suffix sorting, blockwise with a difference cover.

Every byte goes that lies in a string of ``LENGTH`` bytes which also starts
earlier in the corpus. Only suffixes that can match are sorted:

1. Anchors: in every window of ``LENGTH`` bytes, the places whose ``GRAM`` bytes
   have the least hash. Equal windows hold equal anchors at equal places, so a
   match is found among the occurrences of one anchor, and anchors that occur
   once take no further part. Windows that repeat up to ``MAX_PERIOD`` bytes over
   and over would be all anchors: they need none. Of each such run, its first
   period's windows are named by 128 bits; an equal one earlier removes them, and
   the run's other windows repeat these.
2. An anchor's surroundings are all bytes a window around it can reach. Where
   an earlier occurrence has equal surroundings (128 bits name them), all of them
   go without any sorting. The first occurrence of each is kept as a row, if the
   32 bytes before or after its anchor may be another's too (16 bits tell): every
   window around an anchor holds one of the two.
3. Anchors with several different surroundings are the suffix buckets. Tasks take
   a bounded number of rows at a time and sort, for each start in turn, the
   suffixes of all rows that start there. Suffixes are compared by the few bytes
   up to the next place of a difference cover (0, 1 and 3 modulo 7) and, when
   these tie, by the ranks of the suffixes at that place, computed once from
   right to left. Neighbours in suffix order that agree on ``LENGTH`` bytes hold
   a match; all but the earliest are removed.
4. Buckets of more than ``BUCKET_ROWS`` rows are cut; the strings left in each
   part are then compared across parts by their 128-bit names.

An anchor or surroundings of more than ``HOT_ROWS`` occurrences is dealt over
several tasks wherever occurrences are joined.

Defined results: a NULL text is empty; shorter texts lose nothing; rows repeated
with one id are one document and do not remove each other; rows without an id
take no part and lose nothing. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from curbside.llm.text import small_batches
from curbside.operators.joins import lookup_join
from curbside.workspace import staged

LENGTH = 100
GRAM = 32
BEFORE = LENGTH - GRAM
AROUND = BEFORE + LENGTH
STARTS = BEFORE + 1

# Bytes of text, and rows of surroundings, that a task works on at a time.
BLOCK_BYTES = 2 << 20
BLOCK_ROWS = 8_192
BUCKET_ROWS = 65_536
# Occurrences of one anchor that are joined in one task.
HOT_ROWS = 8_192
# Longest repeated unit of windows that need no anchors; less than half of GRAM, so that
# a gram tells the unit.
MAX_PERIOD = 15
# Runs to remove are sent to all tasks up to this size, else joined by document.
RUNS_BYTES = 64 << 20

# A difference cover modulo 7. Its gaps are at most 4 places.
PERIOD, COVER = 7, (0, 1, 3)

_MIXER = np.random.default_rng(5)
_BYTE = _MIXER.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_WORD = _MIXER.integers(1, 1 << 63, AROUND // 8, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACE = _MIXER.integers(1, 1 << 63, (2, AROUND), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _mix(v: np.ndarray) -> np.ndarray:
    v = (v ^ (v >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    v = (v ^ (v >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return v ^ (v >> np.uint64(31))


def _sliding(values: np.ndarray, width: int, best: np.ufunc) -> np.ndarray:
    """Least or greatest of every ``width`` neighbours, by doubling."""
    out, reach = values, 1
    while 2 * reach <= width:
        out = best(out[:-reach], out[reach:])
        reach *= 2
    rest = width - reach
    return best(out[: len(out) - rest], out[rest:]) if rest else out


def _grams(data: np.ndarray) -> np.ndarray:
    """Hash of every ``GRAM`` bytes, never 0."""
    out, reach, power = _BYTE[data], 1, int(_STEP)
    while reach < GRAM:
        out = out[:-reach] * np.uint64(power) + out[reach:]
        power = power * power % (1 << 64)
        reach *= 2
    return _mix(out) | np.uint64(1)


def _periodic_runs(data: np.ndarray, ends: np.ndarray, places: np.ndarray, grams: np.ndarray) -> list[tuple[int, int, int]]:
    """(from, to, period) of longest runs of ``LENGTH`` bytes and more that repeat a short unit.

    In such a run the unit's turn of least hash is an anchor once a period, so runs
    show as equal anchors in equal steps.
    """
    gap = np.diff(places)
    step = np.where((gap <= MAX_PERIOD) & (grams[1:] == grams[:-1]), gap, 0)
    opens = np.flatnonzero(np.diff(step, prepend=-1))
    closes = np.r_[opens[1:], len(step)]
    period = step[opens]
    likely = (period > 0) & (places[closes] - places[opens] + GRAM + 2 * period >= LENGTH)
    runs = set()
    for first, last, unit in zip(places[opens[likely]].tolist(), places[closes[likely]].tolist(), period[likely].tolist()):
        text = int(np.searchsorted(ends, first, side="right")) - 1
        low, high = first, last + GRAM
        while low > ends[text] and data[low - 1] == data[low - 1 + unit]:
            low -= 1
        while high < ends[text + 1] and data[high] == data[high - unit]:
            high += 1
        if high - low >= LENGTH:
            runs.add((low, high, unit))
    return sorted(runs)


def _run_windows(data: np.ndarray, runs: list, start: int, end: int) -> tuple[np.ndarray, ...]:
    """(anchor, name, place, length) of the windows that stand for runs, those from ``start`` to ``end``.

    The first period's windows are named by their bytes; one more row, named as the
    first of them, covers all that follow, which repeat a window before them. These
    anchors are even, those of grams odd.
    """
    anchor, name, place, length = [], [], [], []
    for low, high, unit in runs:
        first, last = max(low, start), min(high - LENGTH, end - 1)
        if last < first:
            continue
        heads = np.arange(first, min(first + unit - 1, last) + 1)
        bytes_ = np.lib.stride_tricks.sliding_window_view(data, LENGTH)[heads].astype(np.uint64) + np.uint64(1)
        one, two = (_mix(bytes_ + weights[:LENGTH]).sum(1, dtype=np.uint64) for weights in _PLACE)
        one &= ~np.uint64(1)
        rest = slice(0, int(last >= first + unit))
        anchor += [one, one[rest]]
        name += [two, two[rest]]
        place += [heads, heads[rest] + unit]
        length += [np.full(len(heads), LENGTH), np.full(rest.stop, last + LENGTH - first - unit)]
    if not anchor:
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    return tuple(np.concatenate(v).view(np.int64) for v in (anchor, name, place, length))


def _anchor_places(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, list]:
    """Places and hashes of the anchors of texts that lie one after another, and the periodic runs."""
    if len(data) < LENGTH:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), []
    grams = _grams(data)
    least = _sliding(grams, STARTS, np.minimum)
    # Windows that reach into the next text do not count.
    border = np.zeros(len(data) + 1, np.int32)
    inner = ends[1:-1]
    np.add.at(border, np.maximum(inner - LENGTH + 1, 0), 1)
    np.add.at(border, inner, -1)
    least[np.cumsum(border)[: len(least)] > 0] = 0
    padded = np.zeros(len(grams) + BEFORE, np.uint64)
    padded[BEFORE : BEFORE + len(least)] = least
    places = np.flatnonzero(_sliding(padded, STARTS, np.maximum) == grams)
    runs = _periodic_runs(data, ends, places, grams[places]) if len(places) > 1 else []
    if runs:
        for low, high, _ in runs:
            padded[BEFORE + low : BEFORE + high - LENGTH + 1] = 0
        places = np.flatnonzero(_sliding(padded, STARTS, np.maximum) == grams)
    return places, grams[places], runs


def _surroundings(data: np.ndarray, ends: np.ndarray, places: np.ndarray):
    """Bytes around each place (zeros beyond its text) and how many are its text's before and after."""
    text = np.searchsorted(ends, places, side="right") - 1
    before = np.minimum(places - ends[text], BEFORE)
    after = np.minimum(ends[text + 1] - places, LENGTH)
    padded = np.zeros(len(data) + AROUND, np.uint8)
    padded[BEFORE : BEFORE + len(data)] = data
    rows = np.lib.stride_tricks.sliding_window_view(padded, AROUND)[places]
    short = np.flatnonzero((before < BEFORE) | (after < LENGTH))
    if len(short):
        column = np.arange(AROUND)
        inside = (column >= BEFORE - before[short, None]) & (column < BEFORE + after[short, None])
        rows[short] *= inside
    return rows, text, before, after


def _names(rows: np.ndarray, before: np.ndarray, after: np.ndarray) -> np.ndarray:
    """64 bits that, with the anchor's own hash, name the surroundings."""
    words = rows.view(np.uint64)
    out = (before * 1_000 + after).astype(np.uint64) * _STEP
    for column in range(words.shape[1]):
        out += _mix(words[:, column] * _WORD[column] + np.uint64(column))
    return _mix(out)


def _marks(rows: np.ndarray) -> np.ndarray:
    """16 bits of the ``GRAM`` bytes before the anchor, then 16 of those after it."""

    def bits(start: int) -> np.ndarray:
        words = np.ascontiguousarray(rows[:, start : start + GRAM]).view(np.uint64)
        return _mix((words * _WORD[: words.shape[1]]).sum(1, dtype=np.uint64)) >> np.uint64(48)

    return (bits(BEFORE - GRAM) << np.uint64(16) | bits(BEFORE + GRAM)).astype(np.int64)


def _pieces(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int, int]]:
    """(bytes, ends, ids, shifts, from, to): whole texts together, or a part of a long one.

    Anchors from ``from`` to ``to`` belong to the piece; a part overlaps its
    neighbours by all that its anchors' surroundings can reach.
    """
    ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
    whole = batch.column("text").cast(pa.large_binary())
    ends = np.frombuffer(whole.buffers()[1], np.int64)[whole.offset : whole.offset + len(whole) + 1]
    held = whole.buffers()[2]
    data = np.frombuffer(held, np.uint8)[ends[0] : ends[-1]] if held is not None else np.zeros(0, np.uint8)
    ends = ends - ends[0]
    if len(data) <= 2 * BLOCK_BYTES or len(ids) > 1:
        yield data, ends, ids, np.zeros(len(ids), np.int64), 0, len(data)
        return
    for start in range(0, len(data), BLOCK_BYTES):
        low, high = max(0, start - 2 * AROUND), min(len(data), start + BLOCK_BYTES + 2 * AROUND)
        part = data[low:high]
        bounds = np.array([0, len(part)])
        yield part, bounds, ids, np.array([low]), start - low, min(start + BLOCK_BYTES, len(data)) - low


def _texts(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.encode(F.col(text), "UTF-8").alias("text"))


def _anchors(texts: DataFrame, named: bool) -> DataFrame:
    """Rows (anchor, name, doc, place, marks, before, after); without ``named``, (anchor, times) by block."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text", BLOCK_BYTES):
            for data, ends, ids, shifts, start, end in _pieces(batch):
                places, grams, runs = _anchor_places(data, ends)
                mine = (places >= start) & (places < end)
                places, grams = places[mine], grams[mine].view(np.int64)
                units, unit_names, heads, lengths = _run_windows(data, runs, start, end)
                if not named:
                    each, times = np.unique(np.r_[grams, units], return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(each), pa.array(times)], names=["anchor", "times"])
                    continue
                rows, text, before, after = _surroundings(data, ends, places)
                where = np.r_[text, np.searchsorted(ends, heads, side="right") - 1]
                none = np.zeros(len(heads), np.int64)
                columns = [
                    np.r_[grams, units],
                    np.r_[_names(rows, before, after).view(np.int64), unit_names],
                    ids[where],
                    np.r_[places, heads] - ends[where] + shifts[where],
                    np.r_[_marks(rows), none],
                    np.r_[before, none],
                    np.r_[after, lengths],
                ]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c.astype(np.int64 if i < 5 else np.int32)) for i, c in enumerate(columns)],
                    names=["anchor", "name", "doc", "place", "marks", "before", "after"],
                )

    sound = texts.where(F.col("doc_id").isNotNull() & (F.octet_length("text") >= LENGTH))
    if not named:
        return sound.mapInArrow(found, "anchor long, times long")
    return sound.mapInArrow(found, "anchor long, name long, doc long, place long, marks long, before int, after int")


def suffix_matches(rows: np.ndarray, bucket: np.ndarray, before: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Whether, for each row and start, an earlier row of its bucket has the same string.

    Rows come ordered by bucket, then by place in the corpus.
    """
    found = np.zeros((len(rows), STARTS), bool)
    cover = [c for c in range(AROUND) if c % PERIOD in COVER]
    following = np.full(AROUND + 1, AROUND)
    for place in range(AROUND - 1, -1, -1):
        following[place] = place if place in cover else following[place + 1]

    def key(start: int, end: int, tail: np.ndarray) -> np.ndarray:
        """Bytes from start to end, then the rank of what follows."""
        out = np.zeros(len(rows), np.uint64)
        for column in range(start, end):
            out = (out << np.uint64(8)) | rows[:, column]
        return (out << np.uint64(32)) | tail

    # The bucket ranks the empty suffix, so suffixes of different buckets never meet.
    ranks = {AROUND: bucket.astype(np.uint64)}
    last = AROUND
    for place in reversed(cover):
        _, rank = np.unique(key(place, last, ranks[last]), return_inverse=True)
        ranks[place] = rank.astype(np.uint64)
        last = place
    for start in range(STARTS):
        whole = np.flatnonzero((before >= BEFORE - start) & (after >= start + LENGTH - BEFORE))
        if len(whole) < 2:
            continue
        after_it = following[start]
        order = whole[np.argsort(key(start, after_it, ranks[after_it])[whole], kind="stable")]
        a, b = order[:-1], order[1:]
        near = bucket[a] == bucket[b]
        near[near] = (rows[a[near], start : start + LENGTH] == rows[b[near], start : start + LENGTH]).all(1)
        opens = np.flatnonzero(np.r_[True, ~near])
        earliest = np.minimum.reduceat(order, opens)
        found[order, start] = order != np.repeat(earliest, np.diff(np.r_[opens, len(order)]))
    return found


def _runs(found: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, first start, last start) of neighbouring starts with a match."""
    edges = np.diff(np.pad(found, ((0, 0), (1, 1))).astype(np.int8), axis=1)
    row, first = np.nonzero(edges == 1)
    _, last = np.nonzero(edges == -1)
    return row, first, last - 1


def _border_rows(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """Rows (anchor, part, parts, doc, place, before, after, bytes) for wanted (anchor, part, parts, doc, place)."""
    listed = wanted.groupBy(F.col("doc").alias("doc_id")).agg(
        F.collect_list(F.struct("place", "anchor", "part", "parts")).alias("places")
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text", BLOCK_BYTES):
            for number in range(batch.num_rows):
                row = batch.slice(number, 1)
                data = np.frombuffer(row.column("text")[0].as_buffer(), np.uint8)
                held = row.column("places").flatten()
                places = held.field("place").to_numpy()
                bounds = np.array([0, len(data)])
                rows, _, before, after = _surroundings(data, bounds, places)
                yield pa.RecordBatch.from_arrays(
                    [
                        held.field("anchor"),
                        held.field("part"),
                        held.field("parts"),
                        pa.array(np.full(len(places), row.column("doc_id")[0].as_py())),
                        pa.array(places),
                        pa.array(before.astype(np.int16)),
                        pa.array(after.astype(np.int16)),
                        pa.FixedSizeBinaryArray.from_buffers(
                            pa.binary(AROUND), len(rows), [None, pa.py_buffer(np.ascontiguousarray(rows))]
                        ).cast(pa.binary()),
                    ],
                    names=["anchor", "part", "parts", "doc", "place", "before", "after", "bytes"],
                )

    # The places are many at any size of corpus, so both sides are always shuffled.
    held = texts.join(listed.hint("merge"), "doc_id")
    return held.mapInArrow(
        cut, "anchor long, part int, parts int, doc long, place long, before short, after short, bytes binary"
    )


def _sorted_buckets(borders: DataFrame) -> DataFrame:
    """Rows (doc, low, high) to remove; from cut buckets also rows (anchor, one, two, doc, low) left over."""
    keys = ["anchor", "part"]
    dealt = borders.repartition(*keys).sortWithinPartitions(*keys, "doc", "place")
    schema = "doc long, low long, high long, anchor long, start short, one long, two long"

    def work(block: pa.Table) -> pa.RecordBatch:
        held = block.column("bytes").combine_chunks()
        held = held.chunk(0) if isinstance(held, pa.ChunkedArray) else held
        ends = np.frombuffer(held.buffers()[1], np.int32)[held.offset : held.offset + len(held) + 1]
        data = np.frombuffer(held.buffers()[2], np.uint8)[ends[0] : ends[-1]]
        rows = data.reshape(len(held), AROUND)
        anchor, part, parts, doc, place, before, after = (
            block.column(c).to_numpy() for c in ("anchor", "part", "parts", "doc", "place", "before", "after")
        )
        # A document read twice brings its rows twice; one of them counts.
        again = np.zeros(len(rows), bool)
        again[1:] = (np.diff(anchor) == 0) & (np.diff(part) == 0) & (np.diff(doc) == 0) & (np.diff(place) == 0)
        rows, anchor, part, parts, doc, place, before, after = (
            v[~again] for v in (rows, anchor, part, parts, doc, place, before, after)
        )
        fresh = np.r_[False, (anchor[1:] != anchor[:-1]) | (part[1:] != part[:-1])]
        found = suffix_matches(rows, np.cumsum(fresh), before, after)
        row, first, last = _runs(found)
        low = place[row] - BEFORE + first
        high = place[row] - BEFORE + last + LENGTH
        empty = np.zeros(0, np.int64)
        rest = [empty] * 6
        cut = np.flatnonzero(parts > 1)
        if len(cut):
            sums = [np.zeros((len(cut), AROUND + 1), np.uint64) for _ in range(2)]
            for total, weights in zip(sums, _PLACE):
                np.cumsum(_mix(rows[cut].astype(np.uint64) + np.uint64(1) + weights), axis=1, out=total[:, 1:])
            start = np.arange(STARTS)
            there = (before[cut, None] >= BEFORE - start) & (after[cut, None] >= start + LENGTH - BEFORE)
            which, at = np.nonzero(there & ~found[cut])
            one, two = ((t[which, at + LENGTH] - t[which, at]).view(np.int64) for t in sums)
            rest = [doc[cut][which], place[cut][which] - BEFORE + at, anchor[cut][which], at, one, two]
        n, m = len(low), len(rest[0])
        blank = lambda v, k, before_it: pa.array(
            np.r_[np.zeros(k, np.int64), v] if before_it else np.r_[v, np.zeros(k, np.int64)]
        )
        mask = np.r_[np.zeros(n, bool), np.ones(m, bool)]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.r_[doc[row], rest[0]].astype(np.int64)),
                pa.array(np.r_[low, rest[1]].astype(np.int64)),
                pa.array(np.r_[high, np.zeros(m, np.int64)].astype(np.int64), mask=mask),
                blank(rest[2], n, True),
                pa.array(np.r_[np.zeros(n), rest[3]].astype(np.int16)),
                blank(rest[4], n, True),
                blank(rest[5], n, True),
            ],
            names=["doc", "low", "high", "anchor", "start", "one", "two"],
        )

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) < BLOCK_ROWS:
                continue
            whole = pa.Table.from_batches(held)
            anchor, part = (whole.column(c).to_numpy() for c in keys)
            cuts = np.flatnonzero((anchor[1:] != anchor[:-1]) | (part[1:] != part[:-1])) + 1
            if not len(cuts):
                continue
            # Whole buckets; the last one may go on in the next batch.
            yield work(whole.slice(0, int(cuts[-1])))
            held = whole.slice(int(cuts[-1])).combine_chunks().to_batches()
        if held and sum(b.num_rows for b in held):
            yield work(pa.Table.from_batches(held))

    return dealt.mapInArrow(blocks, schema)


def _across_parts(left: DataFrame) -> DataFrame:
    """Rows (doc, low, high) of strings left in one part of a cut bucket and earlier in another."""
    name = ["anchor", "start", "one", "two"]
    first = left.groupBy(*name).agg(F.min(F.struct("doc", "low")).alias("first"), F.count(F.lit(1)).alias("n"))
    met = left.join(first.where("n > 1"), name).where(F.struct("doc", "low") != F.col("first"))
    return met.select("doc", "low", (F.col("low") + LENGTH).alias("high"))


def _merged(spans: DataFrame) -> DataFrame:
    """Rows (doc_id, runs): each document's maximal runs of removed bytes, in order."""
    earlier = Window.partitionBy("doc").orderBy("low", "high").rowsBetween(Window.unboundedPreceding, -1)
    apart = F.coalesce(F.col("low") > F.max("high").over(earlier), F.lit(True)).cast("int")
    so_far = Window.partitionBy("doc").orderBy("low", "high").rowsBetween(Window.unboundedPreceding, 0)
    run = spans.withColumn("apart", apart).withColumn("run", F.sum("apart").over(so_far))
    runs = run.groupBy("doc", "run").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    return runs.groupBy(F.col("doc").alias("doc_id")).agg(
        F.sort_array(F.collect_list(F.struct("low", "high"))).alias("runs")
    )


def _met(rows: DataFrame, keyed: DataFrame, keys: list[str]) -> DataFrame:
    """Rows (doc, place, …) with the row of their key in ``keyed``, which says how many ``times`` it occurs.

    Keys of more than ``HOT_ROWS`` rows are dealt over several tasks by document and
    place. These keys are at most one in ``HOT_ROWS`` rows; they are looked up.
    """
    parts = F.ceil(F.col("times") / HOT_ROWS).cast("int")
    hot = keyed.where(F.col("times") > HOT_ROWS).select(*keys, parts.alias("parts"))
    salt = F.pmod(F.xxhash64("doc", "place"), F.coalesce("parts", F.lit(1))).cast("int")
    dealt = lookup_join(rows, hot, keys, "left").withColumn("part", salt).drop("parts")
    copies = keyed.withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("times")
    return dealt.join(copies, [*keys, "part"]).drop("part")


def repeated_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (doc_id, runs array<struct<low, high>>) of documents that lose bytes."""
    texts = _texts(docs, doc_id, text)
    counted = _anchors(texts, named=False).groupBy("anchor").agg(F.sum("times").alias("times"))
    shared = staged(counted.where("times > 1"), "suffix-shared")
    occurrences = staged(_met(_anchors(texts, named=True), shared, ["anchor"]), "suffix-anchors")

    first = occurrences.groupBy("anchor", "name").agg(
        F.min(F.struct("doc", "place", "marks")).alias("first"), F.count(F.lit(1)).alias("times")
    )
    first = staged(first, "suffix-surroundings")
    same_place = (F.col("doc") == F.col("first.doc")) & (F.col("place") == F.col("first.place"))
    again = _met(occurrences.drop("marks"), first.where("times > 1"), ["anchor", "name"])
    inner = again.where(~same_place).select(
        "doc", (F.col("place") - F.col("before")).alias("low"), (F.col("place") + F.col("after")).alias("high")
    )

    grams_only = F.col("anchor").bitwiseAND(F.lit(1)) == 1
    rows = first.where(grams_only).select("anchor", "first.doc", "first.place", "first.marks")
    partnered = []
    for mark in (F.shiftright("marks", 16), F.col("marks").bitwiseAND(0xFFFF)):
        marked = rows.withColumn("mark", mark)
        several = marked.groupBy("anchor", "mark").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        partnered.append(marked.join(several, ["anchor", "mark"], "left_semi").drop("mark", "marks"))
    wanted = staged(partnered[0].unionByName(partnered[1]).distinct(), "suffix-borders")
    sizes = wanted.groupBy("anchor").agg(F.ceil(F.count(F.lit(1)) / BUCKET_ROWS).cast("int").alias("parts"))
    part = F.pmod(F.xxhash64("doc", "place"), F.col("parts")).cast("int")
    wanted = wanted.join(sizes, "anchor").withColumn("part", part)
    matched = staged(_sorted_buckets(_border_rows(texts, wanted)), "suffix-matches")
    border = matched.where("high IS NOT NULL").select("doc", "low", "high")
    across = _across_parts(matched.where("high IS NULL").drop("high"))
    return _merged(inner.unionByName(border).unionByName(across))


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (doc_id, n_bytes, n_removed, n_spans, kept binary), one per document."""
    return _applied(docs, doc_id, text, "kept binary", lambda kept: kept)


def repeat_digests(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (doc_id, n_bytes, n_removed, n_spans, kept_sha256), one per document."""
    return _applied(docs, doc_id, text, "kept_sha256 string", lambda kept: hashlib.sha256(kept).hexdigest())


def _applied(docs: DataFrame, doc_id: str, text: str, column: str, form) -> DataFrame:
    runs = staged(repeated_runs(docs, doc_id, text), "suffix-runs")
    held = lookup_join(_texts(docs, doc_id, text), runs, ["doc_id"], "left", limit=RUNS_BYTES)
    name, kind = column.split(" ")

    def applied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text", BLOCK_BYTES):
            sizes, removed, spans, kept = [], [], [], []
            for whole, listed in zip(batch.column("text"), batch.column("runs").to_pylist()):
                data = whole.as_buffer().to_pybytes() if whole.is_valid else b""
                listed = listed or []
                places = [0, *(p for run in listed for p in (run["low"], run["high"])), len(data)]
                rest = b"".join(data[a:b] for a, b in zip(places[::2], places[1::2]))
                sizes.append(len(data))
                removed.append(len(data) - len(rest))
                spans.append(len(listed))
                kept.append(form(rest))
            arrays = [batch.column("doc_id")] + [pa.array(v, pa.int64()) for v in (sizes, removed, spans)]
            arrays.append(pa.array(kept, pa.binary() if kind == "binary" else pa.string()))
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n_bytes", "n_removed", "n_spans", name])

    return held.mapInArrow(applied, f"doc_id long, n_bytes long, n_removed long, n_spans long, {column}")
