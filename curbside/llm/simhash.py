"""SimHash fingerprints, and the search for all of them within a Hamming radius.

A document's terms are its distinct runs of ``WORDS`` words, so a line repeated a
hundred times says no more than once. A term weighs 1 to 4 by its letters: the more,
the rarer. It votes with its weight and the 128 bits of its hash, for a bit that is
1 and against it where it is 0; the fingerprint holds the bits that won. The share
of differing bits estimates the angle between two documents' weighted term vectors,
so the cosine of that angle is their likeness.

Two sums of votes share one long, so 64 longs hold all 128. Either half has room for
half a milliard of the heaviest terms, more than a text of 2 GB can hold. Only
DataFrame functions are used.

Fingerprints within ``RADIUS`` bits of each other differ in at most that many of
``BLOCKS`` blocks, so they agree on at least two whole blocks. There is one table
per choice of two blocks, which brings these two to the front as the key; equal
fingerprints are one row with a count. A pair is taken from the first table in
which it meets and from no other, after its bits are counted, so none is missed
and none is counted twice.

Defined results: a NULL text is empty; a text without words has the fingerprint of
zeros, is wholly like another one without words, and not at all like any other; one
with fewer words than a term is one term. Documents are ordered by id, NULL first,
then by text. Rows repeated whole are one place in that order, and each row is
returned with its results; the only document of a table is its own next one. An
empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, functions as F

from curbside.llm.order import numbered
from curbside.llm.text import bound, words_of
from curbside.operators.joins import lookup_join
from curbside.workspace import staged

WORDS = 3
LETTERS_PER_WEIGHT = 5
BITS = 128
RADIUS = 4
BLOCKS = RADIUS + 2
# Searched for: documents whose id this number divides.
QUERY_STEP = 50

_HALF = 32
_LANES = (1 << _HALF) | 1  # the lowest bit of both halves of a long
_SIGN = 0x5851F42D4C957F2D  # Fixed value: the second 64 bits are hashed with this number
_KEYS = ["known", "id", "sig"]


def term_hashes(text: Column) -> Column:
    """Distinct hashes of a text's runs of words, whose last two bits are the weight less 1."""

    def runs(words: Column) -> Column:
        starts = F.sequence(F.lit(0), F.greatest(F.size(words) - WORDS, F.lit(0)))

        def hashed(i: Column) -> Column:
            run = [F.get(words, i + k) for k in range(WORDS)]  # past the end NULL, which the hash passes over
            letters = sum((F.coalesce(F.char_length(word), F.lit(0)) for word in run), F.lit(0))
            more = F.greatest(F.lit(0), F.least(F.lit(3), F.floor(letters / LETTERS_PER_WEIGHT) - 1))
            return F.xxhash64(*run).bitwiseAND(F.lit(-4).cast("long")).bitwiseOR(more.cast("long"))

        hashes = F.array_distinct(F.transform(starts, hashed))
        return F.when(F.size(words) > 0, hashes).otherwise(F.array().cast("array<long>"))

    return bound(words_of(text), runs)


def _voted(hashes: DataFrame, keys: list[str]) -> DataFrame:
    """Fingerprints (terms, high, low) of rows (*keys, hash), with the weight of all terms; one row per keys."""
    lanes = F.lit(_LANES)
    halves = {"h": F.xxhash64("hash"), "l": F.xxhash64("hash", F.lit(_SIGN))}
    weight = F.col("hash").bitwiseAND(F.lit(3).cast("long")) + 1
    signed = hashes.select(*keys, weight.alias("weight"), *[half.alias(name) for name, half in halves.items()])
    votes = [
        F.sum(F.col("weight") * F.shiftrightunsigned(name, i).bitwiseAND(lanes)).alias(f"{name}_{i}")
        for name in halves
        for i in range(_HALF)
    ]
    counted = signed.groupBy(*keys).agg(F.coalesce(F.sum("weight"), F.lit(0)).alias("terms"), *votes)

    def bits(name: str) -> Column:
        word = F.lit(0).cast("long")
        for i in range(_HALF):
            lane = F.col(f"{name}_{i}")
            for part, place in ((lane.bitwiseAND(F.lit((1 << _HALF) - 1).cast("long")), i), (F.shiftrightunsigned(lane, _HALF), i + _HALF)):
                mask = (1 << place) - (1 << 64 if place == 63 else 0)
                word = word.bitwiseOR(F.when(2 * part > F.col("terms"), F.lit(mask).cast("long")).otherwise(F.lit(0).cast("long")))
        return word

    return counted.select(*keys, "terms", bits("h").alias("high"), bits("l").alias("low"))


def fingerprints(texts: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """Rows (*keys, terms, high, low) of texts whose ``keys`` name one text each."""
    hashes = texts.select(*keys, F.explode_outer(term_hashes(F.col(text))).alias("hash"))
    voted = _voted(hashes, keys)
    none = F.lit(0).cast("long")
    return voted.withColumns({c: F.when(F.col("terms") > 0, F.col(c)).otherwise(none) for c in ("high", "low")})


def hamming(a_high: Column, a_low: Column, b_high: Column, b_low: Column) -> Column:
    return F.bit_count(a_high.bitwiseXOR(b_high)) + F.bit_count(a_low.bitwiseXOR(b_low))


def likeness(a: str, b: str) -> Column:
    """Cosine of the angle that the differing bits tell, 0 at least; of columns named with prefixes."""
    apart = hamming(F.col(f"{a}high"), F.col(f"{a}low"), F.col(f"{b}high"), F.col(f"{b}low"))
    angle = F.greatest(F.lit(0.0), F.cos(apart * F.lit(3.141592653589793 / BITS)))
    words_a, words_b = F.col(f"{a}terms") > 0, F.col(f"{b}terms") > 0
    return F.when(words_a & words_b, angle).otherwise((words_a == words_b).cast("double"))


def hex_text(high: Column, low: Column) -> Column:
    return F.lower(F.concat(*[F.lpad(F.hex(half), 16, "0") for half in (high, low)]))


# --- the search within a radius --------------------------------------------------


def _block(high: Column, low: Column, number: int) -> Column:
    """One of BLOCKS runs of bits, of 21 or 22 bits each."""
    start, end = number * BITS // BLOCKS, (number + 1) * BITS // BLOCKS
    part = F.lit(0).cast("long")
    for half, base in ((low, 0), (high, 64)):
        a, b = max(start, base), min(end, base + 64)
        if a < b:
            cut = F.shiftrightunsigned(half, a - base).bitwiseAND(F.lit((1 << (b - a)) - 1).cast("long"))
            part = part.bitwiseOR(F.shiftleft(cut, a - start))
    return part


def _tables(prints: DataFrame, high: str, low: str) -> DataFrame:
    """Every fingerprint once for each choice of two blocks, with these two as its key."""
    blocks = [_block(F.col(high), F.col(low), i) for i in range(BLOCKS)]
    choices = [
        F.struct(F.lit(number).alias("choice"), F.shiftleft(blocks[a], 22).bitwiseOR(blocks[b]).alias("front"))
        for number, (a, b) in enumerate(combinations(range(BLOCKS), 2))
    ]
    return prints.select("*", F.inline(F.array(*choices)))


def _first_choice(a: tuple[str, str], b: tuple[str, str]) -> Column:
    """The first choice of two blocks that two fingerprints agree on."""
    same = [
        _block(F.col(a[0]), F.col(a[1]), i) == _block(F.col(b[0]), F.col(b[1]), i) for i in range(BLOCKS)
    ]
    first = F.lit(None).cast("int")
    for number, (x, y) in reversed(list(enumerate(combinations(range(BLOCKS), 2)))):
        first = F.when(same[x] & same[y], F.lit(number)).otherwise(first)
    return first


def within_radius(queries: DataFrame, prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Pairs (high, low, near_high, near_low, near_rows, apart) within ``radius`` bits, at most ``RADIUS``.

    ``queries`` holds fingerprints (high, low), ``prints`` also how many rows have
    each (copies). Both are taken as distinct fingerprints; ``near_rows`` counts the
    rows of ``prints`` that have the one found, and a query finds itself if it is
    among them.
    """
    if radius > RADIUS:
        raise ValueError(f"tables of {BLOCKS} blocks find radii up to {RADIUS}, not {radius}")
    found = prints.groupBy(F.col("high").alias("near_high"), F.col("low").alias("near_low"))
    tables = _tables(found.agg(F.sum("copies").alias("near_rows")), "near_high", "near_low")
    asked = staged(_tables(queries.select("high", "low").distinct(), "high", "low"), "simhash-queries")
    met = lookup_join(tables, asked, ["choice", "front"])
    apart = hamming(*map(F.col, ("high", "low", "near_high", "near_low"))).cast("int")
    near = met.where((apart <= radius) & (F.col("choice") == _first_choice(("high", "low"), ("near_high", "near_low"))))
    return near.select("high", "low", "near_high", "near_low", "near_rows", apart.alias("apart"))


def near_counts(queries: DataFrame, prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Rows (high, low, n_near): how many rows of ``prints`` lie within the radius of each query."""
    pairs = within_radius(queries, prints, radius)
    return pairs.groupBy("high", "low").agg(F.sum("near_rows").alias("n_near"))


# --- documents, their edited texts and their next ones -----------------------------


def _neighbours(keyed: DataFrame) -> DataFrame:
    """Rows (*keys, copies, before_*, asked): the place before each, and how much of this text it asks for."""
    lines = keyed.groupBy(*_KEYS).agg(F.count(F.lit(1)).alias("copies"), F.max("n_chars").alias("n_chars"))
    placed = numbered(lines.withColumn("whole", F.lit(0)), "whole", _KEYS)
    placed = staged(placed.drop("whole"), "simhash-order")
    total = placed.count()
    before = placed.select(
        F.pmod(F.col("at") + 1, F.lit(max(total, 1))).alias("at"),
        *[F.col(k).alias(f"before_{k}") for k in _KEYS],
        F.expr("cast(n_chars div 4 as int)").alias("asked"),
    )
    return placed.drop("n_chars").join(before, "at").drop("at")


def _edited(keyed: DataFrame, near: DataFrame) -> DataFrame:
    """Rows (*keys, copies, text, edited), one per place in the order.

    Texts are shuffled once, to the places' keys; both branches of the second join
    read that shuffle. Only the beginnings that the places before ask for move again.
    """
    placed = keyed.groupBy(*_KEYS).agg(F.first("text").alias("text")).join(near.hint("merge"), _KEYS)
    begun = placed.select(
        *[F.col(f"before_{k}").alias(k) for k in _KEYS],
        F.substring(F.col("text"), F.lit(1), F.col("asked")).alias("borrowed"),
    )
    length = F.char_length("text")
    kept = F.substring(F.col("text"), F.lit(1), length - F.expr("cast(char_length(text) div 4 as int)"))
    met = placed.select(*_KEYS, "copies", "text").join(begun.hint("merge"), _KEYS)
    return met.select(*_KEYS, "copies", "text", F.concat(kept, "borrowed").alias("edited"))


def _both_prints(edited: DataFrame) -> DataFrame:
    """Rows (*keys, copies, n_chars, edited_sha256) with fingerprints of the texts and, prefixed e_, the edited ones."""
    whole = [*_KEYS, "copies", "n_chars", "edited_sha"]
    versions = F.array(
        *[F.struct(F.lit(new).alias("new"), F.col(c).alias("version")) for new, c in ((False, "text"), (True, "edited"))]
    )
    listed = edited.select(
        *_KEYS,
        "copies",
        F.char_length("text").cast("long").alias("n_chars"),
        F.unhex(F.sha2(F.col("edited").cast("binary"), 256)).alias("edited_sha"),
        F.inline(versions),
    )
    prints = fingerprints(listed, [*whole, "new"], "version")
    cells = ["terms", "high", "low"]
    return prints.groupBy(*whole).agg(
        *[F.max(F.when(~F.col("new"), F.col(c))).alias(c) for c in cells],
        *[F.max(F.when(F.col("new"), F.col(c))).alias(f"e_{c}") for c in cells],
    )


def fingerprint_report(docs: DataFrame, query_step: int = QUERY_STEP) -> DataFrame:
    """Rows of doc_id, n_chars, edited_sha256, both fingerprints, near_edited, near_next and n_near.

    The edited text ends in the beginning of the next document instead of its own
    last quarter. ``n_near`` counts the documents within ``RADIUS`` bits, itself
    included, for the documents whose id ``query_step`` divides; it is NULL for others.
    """
    doc_id, text = F.col("doc_id").cast("long"), F.coalesce(F.col("text"), F.lit(""))
    keyed = docs.select(
        doc_id.isNotNull().alias("known"),
        F.coalesce(doc_id, F.lit(0).cast("long")).alias("id"),
        F.unhex(F.md5(text.cast("binary"))).alias("sig"),
        F.char_length(text).cast("long").alias("n_chars"),
        text.alias("text"),
    )
    near = staged(_neighbours(keyed.drop("text")), "simhash-neighbours")
    prints = staged(_both_prints(_edited(keyed.drop("n_chars"), near)), "simhash-prints")

    following = prints.select(*_KEYS, *[F.col(c).alias(f"next_{c}") for c in ("terms", "high", "low")])
    following = following.join(near.drop("copies", "asked"), _KEYS).drop(*_KEYS)
    following = following.withColumnsRenamed({f"before_{k}": k for k in _KEYS})
    asked = F.col("known") & (F.col("id") % query_step == 0)
    counts = staged(near_counts(prints.where(asked), prints), "simhash-near")
    found = lookup_join(prints.join(following, _KEYS), counts, ["high", "low"], "left")

    # A row repeated whole is returned as often as it came, by explosions of bounded lists.
    part = 4_096
    parts = found.select("*", F.explode(F.expr(f"sequence(0L, (copies - 1) div {part})")).alias("_part"))
    every = parts.select("*", F.explode(F.expr(f"sequence(1L, least({part}L, copies - _part * {part}))")).alias("_copy"))
    return every.select(
        F.when(F.col("known"), F.col("id")).alias("doc_id"),
        "n_chars",
        F.lower(F.hex("edited_sha")).alias("edited_sha256"),
        hex_text(F.col("high"), F.col("low")).alias("fingerprint"),
        hex_text(F.col("e_high"), F.col("e_low")).alias("edited_fingerprint"),
        likeness("", "e_").alias("near_edited"),
        likeness("", "next_").alias("near_next"),
        F.when(asked, F.col("n_near")).alias("n_near"),
    )
