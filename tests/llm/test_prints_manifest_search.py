"""Fingerprints, Merkle manifest and ranked search."""

from __future__ import annotations

import hashlib
import math
import random
import re
import struct
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from curbside.llm import merkle_manifest as merkle
from curbside.llm import ranked_search as search
from curbside.llm import simhash
from tests_llm_helpers import as_rows

SMALL = "/root/testdata/sf0.001"


# --- fingerprints ------------------------------------------------------------------


def print_of(text):
    """Fingerprint and weight of all terms, vote by vote."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    votes, seen = np.zeros(128, int), set()
    for i in range(max(len(words) - 3, 0) + 1 if words else 0):
        run, value = words[i : i + 3], 42
        for word in run:
            value = xxhash.xxh64(word.encode(), seed=value).intdigest()
        weight = 1 + max(0, min(3, sum(map(len, run)) // 5 - 1))
        value = value & ~3 | weight - 1
        if value not in seen:
            seen.add(value)
            one = xxhash.xxh64(struct.pack("<Q", value), seed=42).intdigest()
            two = xxhash.xxh64(struct.pack("<q", simhash._SIGN), seed=one).intdigest()
            bits = one << 64 | two
            votes += [weight if bits >> b & 1 else -weight for b in range(128)]
    return sum(1 << b for b in range(128) if votes[b] > 0), len(seen)


def likeness(a, b):
    if a[1] and b[1]:
        return max(0.0, math.cos((a[0] ^ b[0]).bit_count() * math.pi / 128))
    return float((a[1] > 0) == (b[1] > 0))


def expected_prints(rows):
    """Rows in the order of the report, of (doc_id, text)."""
    key = lambda r: (r[0] is not None, r[0] or 0, hashlib.md5((r[1] or "").encode()).digest())
    places = sorted({key(r): (r[0], r[1] or "") for r in rows}.items())
    at = {k: i for i, (k, _) in enumerate(places)}
    prints = {k: print_of(t) for k, (_, t) in places}
    out = []
    for row in rows:
        k, text = key(row), row[1] or ""
        following, (_, other) = places[(at[k] + 1) % len(places)]
        cut = len(text) // 4
        edited = text[: len(text) - cut] + other[:cut]
        own, new = prints[k], print_of(edited)
        near = sum((own[0] ^ prints[key(r)][0]).bit_count() <= simhash.RADIUS for r in rows)
        out.append(
            (
                row[0],
                len(text),
                hashlib.sha256(edited.encode()).hexdigest(),
                f"{own[0]:032x}",
                f"{new[0]:032x}",
                round(likeness(own, new), 9),
                round(likeness(own, prints[following]), 9),
                near if row[0] is not None and row[0] % simhash.QUERY_STEP == 0 else None,
            )
        )
    return out


def reported(docs):
    rows = simhash.fingerprint_report(docs).collect()
    return [(*r[:5], round(r[5], 9), round(r[6], 9), r[7]) for r in rows]


def test_fingerprints_equal_counted_votes(spark, documents):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    assert as_rows(reported(docs)) == as_rows(expected_prints([r[:2] for r in documents]))


def test_fingerprints_of_odd_rows(make_docs, odd_rows):
    rows = [*odd_rows, (50, "one two three four five six seven"), (0, None), (0, None), (0, "a b")]
    assert as_rows(reported(make_docs(rows))) == as_rows(expected_prints([r[:2] for r in rows]))


def test_fingerprints_of_no_and_of_one_document(make_docs):
    assert reported(make_docs([])) == []
    one = [(7, "alpha beta gamma delta")]
    assert reported(make_docs(one)) == expected_prints(one)


def test_radius_search_finds_every_pair(spark):
    rng = random.Random(5)
    prints = [rng.getrandbits(128) for _ in range(40)]
    for value in prints[:25]:  # neighbours at distances around the radius, bits in few or many blocks
        for flips in range(1, 8):
            places = rng.sample(range(128), flips) if rng.random() < 0.7 else range(60, 60 + flips)
            prints.append(value ^ sum(1 << p for p in places))
    halves = lambda v: [x - (1 << 64) if x >> 63 else x for x in (v >> 64, v & (1 << 64) - 1)]
    table = spark.createDataFrame([(*halves(v), 1) for v in prints], "high long, low long, copies long")
    found = simhash.within_radius(table, table).collect()
    want = [
        (*halves(a), *halves(b), prints.count(b), (a ^ b).bit_count())
        for a in set(prints)
        for b in set(prints)
        if (a ^ b).bit_count() <= simhash.RADIUS
    ]
    assert as_rows(found) == as_rows(want)
    narrow = simhash.within_radius(table, table, 1).collect()
    assert as_rows(narrow) == as_rows(r for r in want if r[-1] <= 1)
    with pytest.raises(ValueError):
        simhash.within_radius(table, table, simhash.RADIUS + 1)


def test_fingerprints_need_no_python_worker(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    keyed = docs.select(
        F.lit(True).alias("known"), F.col("doc_id").alias("id"), F.unhex(F.md5("text")).alias("sig"),
        F.char_length("text").cast("long").alias("n_chars"), "text",
    )
    near = simhash._neighbours(keyed.drop("text"))
    plan = simhash._both_prints(simhash._edited(keyed.drop("n_chars"), near))._jdf.queryExecution().toString()
    assert "Arrow" not in plan and "Python" not in plan and "Pandas" not in plan


# --- manifest ----------------------------------------------------------------------


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row):
    cells = ("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row)
    return sha("".join(cells))


def pair_up(nodes):
    return [sha("".join(nodes[i : i + 2])) for i in range(0, len(nodes), 2)]


def climb(nodes, at, node):
    """The root over nodes with ``node`` in place of its own, and the siblings on the way."""
    siblings = []
    while len(nodes) > 1:
        run = [node if i == at else nodes[i] for i in range(at & ~1, min(len(nodes), (at & ~1) + 2))]
        siblings += [nodes[i] for i in range(at & ~1, min(len(nodes), (at & ~1) + 2)) if i != at]
        nodes, at, node = pair_up(nodes), at >> 1, sha("".join(run))
    return node, siblings


def root_of(nodes):
    while len(nodes) > 1:
        nodes = pair_up(nodes)
    return nodes[0]


def expected_manifest(rows):
    """Of rows (doc_id, source, lang, n_chars, text)."""
    trees = {}
    for row in rows:
        trees.setdefault(row[2], []).append(row)
    order = sorted(trees, key=lambda lang: (lang is not None, (lang or "").encode()))
    for lang in order:
        trees[lang].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
    leaves = {lang: [leaf_of(r) for r in trees[lang]] for lang in order}
    subroots = [root_of(leaves[lang]) for lang in order]
    root, out = root_of(subroots), []
    for number, lang in enumerate(order):
        for at, row in enumerate(trees[lang]):
            doc, source, _, n, text = row
            hit = doc is not None and zlib.crc32(str(doc).encode()) % 7 == 0 and n is not None
            changed = leaf_of((doc, source, lang, n + 1, text)) if hit else leaf_of(row)
            node, proof = climb(leaves[lang], at, changed)
            folded, more = climb(subroots, number, node)
            digest = sha("".join(proof + more))
            out.append((doc, leaf_of(row), subroots[number], root, digest, folded, folded == root))
    return out


def in_fields(docs, rows):
    """Rows (doc_id, source, lang, n_chars, text) of the frame's rows."""
    return [(r["doc_id"], r["source"], r["lang"], r["n_chars"], r["text"]) for r in rows or docs.collect()]


@pytest.mark.parametrize("levels", range(1, 12))
def test_layout_gives_every_node_a_place_and_keeps_subtrees_together(levels):
    places = [merkle.address(levels, d, np.arange(1 << d)) for d in range(levels)]
    assert sorted(np.concatenate(places).tolist()) == list(range((1 << levels) - 1))
    upper = levels // 2
    if upper:
        assert max(p.max() for p in places[:upper]) == (1 << upper) - 2
        lower = (1 << levels - upper) - 1
        for tree in range(1 << upper):
            held = [places[d][tree << d - upper : tree + 1 << d - upper] for d in range(upper, levels)]
            held = np.sort(np.concatenate(held))
            assert held.tolist() == list(range((1 << upper) - 1 + tree * lower, (1 << upper) - 1 + (tree + 1) * lower))


@pytest.mark.parametrize("height", [1, 2, 3, 10])
def test_manifest_equals_trees_built_by_hand(spark, monkeypatch, height):
    monkeypatch.setattr(merkle, "HEIGHT", height)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").where("doc_id < 90")
    assert as_rows(merkle.tampered_check(docs).collect()) == as_rows(expected_manifest(in_fields(docs, None)))


def test_manifest_equals_sql(spark, sf):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    duck = duckdb.connect()
    duck.execute(f"create view documents as select * from '{SMALL}/documents.parquet'")
    want = duck.execute(merkle.SQL).fetchall()
    assert as_rows(merkle.tampered_check(docs).collect()) == as_rows(want)
    assert {r[-1] for r in want} == {True, False}


def test_manifest_of_odd_rows_many_languages_and_no_rows(make_docs, odd_rows, monkeypatch):
    monkeypatch.setattr(merkle, "HEIGHT", 1)
    rows = [*odd_rows, *((100 + i, f"text {i}", f"l{i % 9}é", "s") for i in range(20))]
    docs = make_docs(rows).withColumn("n_chars", F.when(F.col("doc_id") % 5 != 0, F.length("text").cast("long")))
    found = merkle.tampered_check(docs).collect()
    assert as_rows(found) == as_rows(expected_manifest(in_fields(docs, None)))
    assert merkle.tampered_check(make_docs([])).collect() == []


def test_manifest_stores_all_nodes_once(spark, monkeypatch):
    monkeypatch.setattr(merkle, "HEIGHT", 2)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    blocks = merkle.build_manifest(docs).blocks().collect()
    sizes = Counter(r["lang"] for r in docs.select("lang").collect())
    lowest = [r for r in blocks if r["part"] == "group" and r["tier"] == 0]
    assert {(r["tree"], r["total"]) for r in lowest} == {(f"={lang}", n) for lang, n in sizes.items()}
    assert all(len(r["nodes"]) == 32 * ((1 << r["levels"]) - 1) for r in blocks)
    assert sum(r["n"] for r in lowest) == sum(sizes.values())


# --- ranked search -------------------------------------------------------------------


def words_of(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower)


def expected_ranks(docs, items, top=search.TOP):
    counted = [(doc, Counter(words_of(text))) for doc, text in docs]
    counted = [(doc, terms) for doc, terms in counted if terms]
    n_docs, length = len(counted), sum(sum(t.values()) for _, t in counted)
    holding = Counter(t for _, terms in counted for t in terms)
    asked = {}
    for item, text in items:
        if item is not None:
            asked.setdefault(item, set()).update(words_of(text))
    out = []
    for item, terms in asked.items():
        scored = []
        for doc, found in counted:
            m = 50 + 50 * sum(found.values()) * n_docs // length
            score = 0
            for t in terms & found.keys():
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * holding[t] + 1)))
                score += w * (10**9 * found[t] // (1000 * found[t] + 20 * m))
            if score > 0 and doc is not None:
                scored.append((-score, doc))
        out += [(item, i + 1, doc, -s) for i, (s, doc) in enumerate(sorted(scored)[:top])]
    return out


@pytest.fixture
def small_parts(monkeypatch):
    """Many shards, passes and little that fits, so that accumulators are dropped and merged."""
    monkeypatch.setattr(search, "SHARD_DOCUMENTS", 30)
    monkeypatch.setattr(search, "PASS_ITEMS", 15)


@pytest.mark.parametrize("top", [1, 5, 50])
def test_search_equals_scoring_all(spark, documents, small_parts, top):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    items = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    want = expected_ranks([r[:2] for r in documents], [tuple(r) for r in items.collect()], top)
    assert as_rows(search.search(docs, items, top).collect()) == as_rows(want)


def test_search_equals_sql(spark):
    duck = duckdb.connect()
    for name in ("documents", "benchmark"):
        duck.execute(f"create view {name} as select * from '{SMALL}/{name}.parquet'")
    frames = [spark.read.parquet(f"{SMALL}/{name}.parquet") for name in ("documents", "benchmark")]
    assert as_rows(search.search(*frames).collect()) == as_rows(duck.execute(search.SQL).fetchall())


def test_search_of_odd_rows(spark, make_docs, odd_rows, small_parts):
    rows = [*odd_rows, (12, "One-two THREE four"), (13, "one"), (14, "one"), (15, "é日本語 one")]
    items = [(1, "one two the"), (1, "seven"), (2, None), (3, ""), (None, "one"), (4, "absent words"), (5, "日本語 É12")]
    table = spark.createDataFrame(items, "item_id long, text string").withColumn("score", F.lit("x"))
    want = expected_ranks([r[:2] for r in rows], items)
    assert as_rows(search.search(make_docs(rows), table).collect()) == as_rows(want)
    assert search.search(make_docs([]), table).collect() == []
    assert search.search(make_docs([(1, None)]), table).collect() == []
    assert search.search(make_docs(rows), table.limit(0)).collect() == []


def test_dropped_accumulators_could_not_win():
    """Owners one by one, with and without dropping, over random postings."""
    import pyarrow as pa

    rng = np.random.default_rng(2)
    docs, terms, top = 60, 8, 3
    tfs = rng.integers(0, 4, (docs, terms)) * (rng.random((docs, terms)) < 0.5)
    weights, m = rng.integers(1, 5000, terms), rng.integers(50, 200, docs)
    share = 10**9 * tfs // (1000 * tfs + 20 * m[:, None])
    whole = (share * weights).sum(1)
    want = sorted(np.flatnonzero(whole), key=lambda d: (-whole[d], d))[:top]

    lists = lambda cells: pa.ListArray.from_arrays(
        pa.array(np.append(0, np.cumsum([len(c) for c in cells])), pa.int32()),
        pa.array(np.concatenate([np.asarray(c, np.int64) for c in cells]) if cells else np.zeros(0, np.int64)),
    )
    bundle = pa.table({"shard": pa.array([], pa.int64()), "item": pa.array([], pa.int32()), **{c: lists([]) for c in ("rows", "docs", "scores")}})
    kept_counts = []
    for owner in range(4):
        mine = [2 * owner, 2 * owner + 1]
        held = [d for d in range(docs) if tfs[d, mine].any()]
        postings = pa.table(
            {
                "shard": pa.array([0] * len(held)), "row": pa.array(held), "doc_id": pa.array(held), "m": pa.array(m[held]),
                "terms": lists([[t for t in mine if tfs[d, t]] for d in held]),
                "tfs": lists([[tfs[d, t] for t in mine if tfs[d, t]] for d in held]),
            }
        )
        rest = int(sum(weights[t] * share[:, t].max() for t in range(2 * owner + 2, terms)))
        shard = search.Shard(bundle, postings)
        found = shard.accumulate(0, np.array(mine), weights[mine].tolist())
        kept = shard.best(found, top) if owner == 3 else shard.still_possible(found, rest, top)
        kept_counts.append((len(found), len(kept)))
        bundle = pa.table(
            {
                "shard": pa.array([0]), "item": pa.array([0], pa.int32()),
                "rows": lists([shard.rows[kept]]), "docs": lists([shard.docs[kept]]), "scores": lists([shard.scores[kept]]),
            }
        )
    assert shard.docs[kept].tolist() == [int(d) for d in want]
    assert shard.scores[kept].tolist() == [int(whole[d]) for d in want]
    assert any(kept < found for found, kept in kept_counts[:3])
