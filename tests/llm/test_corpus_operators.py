"""Mixing, nearest neighbours, similarity join, suffix dedup and the pipeline."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline
from curbside.llm import ann_multiprobe as ann
from curbside.llm import bpe_transducer as bpe
from curbside.llm import catalog, language_gru, mixing, pii_feistel
from curbside.llm import shingle_join as join
from curbside.llm import suffix_dedup as suffix
from curbside.llm.components import components
from curbside.llm.text import table
from tests_llm_helpers import as_rows

# Mixing


def settled_targets(sizes, weights=mixing.WEIGHTS, share=mixing.SHARE):
    """Share by weight; what exceeds a cap is shared again, until nothing does."""
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {name: weights[i % len(weights)] for i, name in enumerate(names)}
    target, free, rest = {}, set(names), share * sum(sizes.values())
    while free:
        unit = rest / sum(weight[s] for s in free)
        over = {s for s in free if weight[s] * unit > 2 * sizes[s]}
        for s in over or free:
            target[s] = 2 * sizes[s] if over else weight[s] * unit
            rest -= target[s] if over else 0
        free = free - over if over else set()
    return target


def check_mix(rows, result):
    size_of = lambda t: len((t or "").encode().split())
    sizes = defaultdict(int)
    for _, text, _, source in rows:
        sizes[source] += size_of(text)
    targets = settled_targets(sizes)
    taken, largest = defaultdict(int), defaultdict(int)
    assert len(result) == len(rows)
    for r in result:
        assert r["taken"] == r["copies"] * r["size"] and 0 <= r["copies"] <= 2
        assert r["source_size"] == sizes[r["source"]]
        assert np.isclose(r["target"], targets[r["source"]], rtol=1e-9, atol=1e-6)
        taken[r["source"]] += r["taken"]
        largest[r["source"]] = max(largest[r["source"]], r["size"])
    for source, target in targets.items():
        assert abs(taken[source] - target) <= 0.5 * largest[source] + 1e-6


def test_mix_meets_targets(make_docs, documents):
    docs = make_docs([tuple(d) for d in documents])
    result = mixing.mix_rates(docs).collect()
    check_mix(documents, result)
    again = mixing.mix_rates(make_docs([tuple(d) for d in documents], partitions=7)).collect()
    assert as_rows(result) == as_rows(again)


def test_mix_of_odd_documents(make_docs, odd_rows):
    docs = make_docs(odd_rows)
    check_mix(odd_rows, mixing.mix_rates(docs).collect())
    assert mixing.mix_rates(docs.limit(0)).count() == 0
    mixed = mixing.mix_documents(docs)
    assert mixed.columns == docs.columns
    copies = Counter()
    for r in mixing.mix_rates(docs).collect():
        copies[r["doc_id"]] += r["copies"]
    assert Counter(r["doc_id"] for r in mixed.select("doc_id").collect()) == +copies


def test_a_hot_group_of_equal_documents_is_split_exactly(make_docs):
    rows = [(i, "a b c", "en", "a") for i in range(3_000)] + [(5_000 + i, "a b c d", "en", "b") for i in range(500)]
    result = mixing.mix_rates(make_docs(rows)).collect()
    check_mix(rows, result)
    assert len({r["copies"] for r in result if r["source"] == "a"}) <= 2


def test_rates_are_exponential_tilts(make_docs, spark):
    rows = [(i, "w " * (1 + i % 9), "en", s) for s in ("a", "b", "c") for i in range(90)]
    counts = spark.createDataFrame([(f"0{s}", n, 10) for s in "abc" for n in range(1, 10)], "key string, size long, n long")
    sources = mixing.targets(counts.selectExpr("key", "n * size as w").groupBy("key").sum("w").toDF("key", "source_size"))
    for r in mixing.solve_duals(counts, sources).collect():
        assert (r["multiplier"] is None) == (r["target"] >= 2 * r["source_size"])
        if r["multiplier"] is not None:
            n = np.arange(1, 10)
            v = r["multiplier"] * n / r["mean"]
            assert np.isclose((10 * n * 2 / (1 + np.exp(-v))).sum(), r["target"], rtol=1e-8)


# Nearest neighbours


def nearest(vectors, query, k=10):
    ranked = []
    for number, v in vectors.items():
        if number != query:
            ranked.append((float(np.sqrt(((np.array(v) - np.array(vectors[query])) ** 2).sum())), number))
    return sorted(ranked)[:k]


def test_moves_come_in_order_of_cost():
    places = np.array([0.1, 0.4, 0.75])
    found = ann.moves(places, 20)
    cost = lambda m: sum((p - np.floor(p) if s < 0 else 1 - p + np.floor(p)) ** 2 for p, s in zip(places, m) if s)
    costs = [cost(m) for m in found]
    assert costs == sorted(costs) and len({tuple(m) for m in found}) == len(found) == 20
    every = sorted(cost((a, b, c)) for a in (-1, 0, 1) for b in (-1, 0, 1) for c in (-1, 0, 1))
    assert np.allclose(costs, every[:20])


def test_recall_against_all_rows(spark):
    rows = table(spark, "/root/testdata/sf0.01", "embeddings")
    vectors = {r["vec_id"]: np.array(r["embedding"], float) for r in rows.collect()}
    found = defaultdict(list)
    for r in ann.search(rows, lambda v: v % 20 == 0).orderBy("query_id", "rank").collect():
        found[r["query_id"]].append((r["score"], r["vec_id"]))
        assert r["rank"] == len(found[r["query_id"]])
    hits = 0
    for query, listed in found.items():
        assert listed == sorted(listed) and len(listed) == 10
        assert all(np.isclose(s, np.linalg.norm(vectors[query] - vectors[v]), rtol=1e-12) for s, v in listed)
        hits += len({v for _, v in listed} & {v for _, v in nearest(vectors, query)})
    assert len(found) == 25 and hits / 250 >= 0.9


def test_odd_vectors_and_ties(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [1.0, 2.0], "x") for i in range(300)] + [(300 + i, [1.0 + i, 2.0], "x") for i in range(1, 40)]
    odd = [(900, None, "x"), (901, [0.0, 0.0], "x"), (902, [nan, 1.0], "x"), (903, [inf, 1.0], "x")]
    odd += [(904, [1.0, None], "x"), (905, [1.0, 2.0, 3.0], "x"), (None, [1.0, 2.0], "x"), (5, [1.0, 2.0], "x")]
    docs = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>, score string")
    found = defaultdict(list)
    for r in ann.search(docs, lambda v: v % 100 == 0).orderBy("query_id", "rank").collect():
        found[r["query_id"]].append((r["score"], r["vec_id"]))
    vectors = {r[0]: r[1] for r in rows}
    assert set(found) == {0, 100, 200}
    assert all(found[q] == nearest(vectors, q) for q in found)
    few = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(0, 500, 100)], "vec_id long, embedding array<float>")
    assert ann.search(few, lambda v: v % 100 == 0).count() == 5 * 4
    assert ann.search(docs.limit(0), lambda v: v % 100 == 0).count() == 0


def test_large_buckets_are_compared_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK", 16)
    rng = np.random.default_rng(8)
    vectors = {i: rng.normal(size=4).tolist() for i in range(200)}
    docs = spark.createDataFrame(list(vectors.items()), "vec_id long, embedding array<double>")
    found = ann.search(docs, lambda v: v % 50 == 0, width=50.0)  # one bucket holds them all
    listed = defaultdict(list)
    for r in found.orderBy("query_id", "rank").collect():
        listed[r["query_id"]].append(r["vec_id"])
    assert all(listed[q] == [v for _, v in nearest(vectors, q)] for q in (0, 50, 100, 150))


# Similarity join


def shingles(text, size=5):
    fold = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
    words = (text or "").encode().translate(fold).split()
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def groups(rows):
    sets = {i: shingles(t) for i, t in rows if i is not None}
    root = {i: i for i in sets}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                low, high = sorted((top(a), top(b)))
                root[high] = low
    return {i: (len(s), top(i)) for i, s in sets.items()}


def copies(rng, count, words, changes):
    base = [f"w{rng.randrange(500)}" for _ in range(words)]
    for _ in range(count):
        text = list(base)
        for _ in range(rng.randint(0, changes)):
            text[rng.randrange(len(text))] = f"v{rng.randrange(1000)}"
        yield " ".join(text)


@pytest.mark.parametrize("rounds", [0, 1, 2])
def test_groups_equal_brute_force(make_docs, documents, odd_rows, rounds, monkeypatch):
    monkeypatch.setattr(join, "ROUNDS", rounds)
    rng = random.Random(9)
    texts = [t for _ in range(4) for t in copies(rng, 12, rng.choice((30, 80, 200)), 9)]
    texts += [t for _ in range(6) for t in copies(rng, 4, rng.randint(4, 9), 1)]
    shared = " ".join(f"p{i}" for i in range(60))
    texts += [shared + " " + " ".join(f"u{rng.randrange(9999)}" for _ in range(rng.choice((5, 20, 90)))) for _ in range(25)]
    rows = [(100 + i, t) for i, t in enumerate(texts)] + [(r[0], r[1]) for r in odd_rows]
    rows += [(1_000 + d[0], d[1]) for d in documents[:60]]
    rng.shuffle(rows)
    expected = groups(rows)
    result = join.near_duplicates(make_docs(rows)).collect()
    assert len(result) == len(rows)
    for r in result:
        if r["doc_id"] is None:
            assert r["component_id"] is None
        else:
            assert (r["n_shingles"], r["component_id"]) == expected[r["doc_id"]], r


def test_texts_of_one_id_are_one_document(make_docs):
    a, b = (" ".join(f"{c}{i}" for i in range(40)) for c in "ab")
    rows = [(1, a), (5, a), (5, b), (7, b), (9, b + " end"), (5, ""), (20, "other words"), (21, None)]
    found = sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in join.near_duplicates(make_docs(rows)).collect())
    assert found == [(1, 36, 1), (5, 0, 5), (5, 36, 1), (5, 36, 1), (7, 36, 1), (9, 37, 1), (20, 1, 20), (21, 0, 21)]


def test_variants_too_far_apart_are_hardly_compared(make_docs, monkeypatch):
    """Hundreds of variants of one text, of which many are not near any other, and holders of a passage."""
    rng = random.Random(8)
    base = [f"w{i}" for i in range(150)]
    texts = [" ".join(base)]
    for i in range(400):
        text = list(base)
        for place in rng.sample(range(150), rng.choice((2, 3, 9, 12))):
            text[place] = f"v{rng.randrange(60)}"
        texts.append(" ".join(text))
    passage = " ".join(f"p{i}" for i in range(40))
    texts += [passage + " " + " ".join(f"u{i}x{j}" for j in range(30)) for i in range(300)]
    rows = list(enumerate(texts))
    compared = []

    def counted(pairs, segments, linked=join._linked):
        compared.append(pairs.count())
        return linked(pairs, segments)

    monkeypatch.setattr(join, "_linked", counted)
    result = join.near_duplicates(make_docs(rows)).collect()
    expected = groups(rows)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in result} == expected
    assert sum(compared) < 6 * len(rows)


def test_one_of_each_group_stays(make_docs, odd_rows):
    docs = make_docs(odd_rows)
    kept = join.keep_first_of_each_group(docs)
    assert kept.columns == docs.columns
    ids = sorted((r["doc_id"] for r in kept.select("doc_id").collect()), key=lambda i: (i is None, i))
    assert ids == [1, 2, 3, 4, 5, 7, 9, 10, 11, None]
    assert join.near_duplicates(docs.limit(0)).count() == 0
    assert join.keep_first_of_each_group(docs.limit(0)).count() == 0


@pytest.mark.parametrize("shape", ["path", "star", "random"])
def test_components(spark, shape):
    rng = random.Random(4)
    pairs = {
        "path": [(i, i + 1) for i in range(40)],
        "star": [(99, i) for i in range(30)],
        "random": [(rng.randrange(60), rng.randrange(60)) for _ in range(45)],
    }[shape]
    root = {}
    for a, b in pairs:
        low = min(root.get(a, a), root.get(b, b))
        old = {root.get(a, a), root.get(b, b)}
        root.update({n: low for n in [*root, a, b] if root.get(n, n) in old})
    expected = {n: r for n, r in root.items() if any(n in p for p in pairs if p[0] != p[1])}
    found = components(spark.createDataFrame(pairs, "a long, b long")).collect()
    assert {r["node"]: r["root"] for r in found} == expected


# Suffix dedup


def removed(rows, length=100):
    """Bytes to remove, from a set of all strings met so far."""
    met, result = {}, {}
    for doc, text in sorted({r for r in rows if r[0] is not None}):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - length + 1):
            if met.setdefault(data[i : i + length], (doc, i)) != (doc, i):
                gone[i : i + length] = b"\1" * length
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        result[doc] = (len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return result


def passages(rng):
    letters = "abcdeé "
    text = lambda n: "".join(rng.choice(letters) for _ in range(n))
    shared = [text(n) for n in (60, 95, 100, 101, 130, 180, 400)]
    rows = []
    for i in range(60):
        parts = [text(rng.randint(0, 150)) if rng.random() < 0.5 else rng.choice(shared) for _ in range(rng.randint(1, 5))]
        rows.append((i, "".join(parts)))
    rows += [(70, "ab" * 400), (71, "a" * 500), (72, "b" + "a" * 120), (73, rows[3][1]), (74, None), (75, ""), (None, "ab" * 90)]
    rows += [(76, shared[-1] * 3), (76, shared[-1] * 3)]
    return rows


@pytest.mark.parametrize("bucket, block", [(4_096, 8_192), (4, 16)])
def test_removed_bytes_equal_brute_force(make_docs, monkeypatch, bucket, block):
    monkeypatch.setattr(suffix, "BUCKET_ROWS", bucket)
    monkeypatch.setattr(suffix, "BLOCK_ROWS", block)
    rows = passages(random.Random(bucket))
    expected = removed(rows)
    result = suffix.repeat_digests(make_docs(rows)).collect()
    assert len(result) == len(rows)
    for r in result:
        if r["doc_id"] is None:
            assert r["n_removed"] == 0
        else:
            assert tuple(r[1:]) == expected[r["doc_id"]], r
    kept = suffix.remove_repeats(make_docs(rows)).collect()
    assert all(hashlib.sha256(r["kept"]).hexdigest() == expected[r["doc_id"]][3] for r in kept if r["doc_id"] is not None)


def test_long_texts_are_read_in_parts(make_docs, monkeypatch):
    monkeypatch.setattr(suffix, "BLOCK_BYTES", 1_000)
    rng = random.Random(7)
    part = "".join(rng.choice("abcdef ") for _ in range(2_500))
    rows = [(1, part * 2 + "x"), (2, "y" * 2_300 + part[700:1_900] + "z" * 90), (3, "short")]
    result = suffix.repeat_digests(make_docs(rows, partitions=1)).collect()
    expected = removed(rows)
    assert {r["doc_id"]: tuple(r[1:]) for r in result} == expected


def periodic(rng):
    """Texts full of runs that repeat one to twenty bytes, of lengths about 100 and far above."""
    rows = []
    for i in range(40):
        parts = []
        for _ in range(rng.randint(1, 5)):
            unit = rng.choice(["-", "=", "ab", "ba", "=-=", "aab", "é", "0123456", "abcdefghijklmn_", "abcdefghijklmn_o", "abcdefghij0123456789"])
            shift = rng.randrange(len(unit))
            run = (unit[shift:] + unit * 80)[: rng.choice([60, 99, 100, 101, 115, 131, 400, 1_300])]
            parts += [run, "".join(rng.choice("ab-=c") for _ in range(rng.choice([0, 0, 1, 5, 120])))]
        rows.append((i, "".join(parts)))
    return rows + [(40, "-" * 100), (41, "-" * 99), (42, "ab" * 50), (42, "ab" * 50), (None, "-" * 200)]


@pytest.mark.parametrize("seed, bytes_, hot", [(1, 2 << 20, 8_192), (2, 1_000, 2), (3, 300, 1)])
def test_periodic_runs_equal_brute_force(make_docs, monkeypatch, seed, bytes_, hot):
    monkeypatch.setattr(suffix, "BLOCK_BYTES", bytes_)
    monkeypatch.setattr(suffix, "HOT_ROWS", hot)
    rows = periodic(random.Random(seed))
    expected = removed(rows)
    for r in suffix.repeat_digests(make_docs(rows)).collect():
        if r["doc_id"] is not None:
            assert tuple(r[1:]) == expected[r["doc_id"]], r


def test_long_constant_texts_give_few_anchors(make_docs, spark):
    size = 5_000_000
    docs = make_docs([(1, "x" * size), (2, "x" * size), (3, "ab" * 50 + "c"), (4, "xy" * 400_000)])
    texts = suffix._texts(docs, "doc_id", "text")
    assert suffix._anchors(texts, named=True).count() < 100
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"]) for r in suffix.repeat_digests(docs).collect()}
    # Strings of one letter start again one byte on, those of two letters two bytes on.
    assert got == {1: (size, size - 1, 1), 2: (size, size, 1), 3: (101, 0, 0), 4: (800_000, 799_998, 1)}


def test_difference_cover():
    reached = {(a - b) % suffix.PERIOD for a in suffix.COVER for b in suffix.COVER}
    assert reached == set(range(suffix.PERIOD))


def test_no_repeats_and_no_rows(make_docs, odd_rows):
    docs = make_docs([(1, "nothing twice"), (2, None)])
    assert all(r["n_removed"] == 0 for r in suffix.repeat_digests(docs).collect())
    assert suffix.repeat_digests(docs.limit(0)).count() == 0


# Queries and pipeline


def test_every_operator_has_its_query():
    assert [name.split("_")[0] for name in catalog.QUERIES] == [f"op{n}" for n in range(1, 11)]
    assert set(catalog.ORACLES) <= set(catalog.QUERIES)


def test_pipeline_stages_do_what_they_say(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    held = {}
    given = docs
    for name, stage in corpus_pipeline.STAGES:
        held[name] = stage(spark, given, sf).persist()
        if name != "tokens":
            assert held[name].columns == docs.columns
            given = held[name]
    rows = {name: as_rows(df.collect()) for name, df in held.items()}
    everything = as_rows(docs.collect())
    assert set(rows["language"]) <= set(everything)
    letters = {r[0] for r in everything if r[1] and language_gru.LETTER.search(r[1])}
    assert {r[0] for r in rows["language"]} == letters
    expected = groups([(r[0], r[1]) for r in rows["language"]])
    assert {r[0] for r in rows["near_copies"]} == {i for i, (_, top) in expected.items() if top == i}
    names = pii_feistel.Pseudonyms(catalog.PSEUDONYM_KEY)
    fresh = [(r[0], names.replace(r[1])[0], *r[2:]) for r in rows["near_copies"]]
    assert rows["pseudonyms"] == as_rows(fresh)
    assert set(rows["mix"]) <= set(rows["pseudonyms"])
    rates = {r["doc_id"]: r["copies"] for r in mixing.mix_rates(held["pseudonyms"]).collect()}
    assert Counter(r[0] for r in rows["mix"]) == +Counter(rates)
    check_mix([(r[0], r[1], r[2], r[3]) for r in rows["pseudonyms"]], mixing.mix_rates(held["pseudonyms"]).collect())
    vocabulary = bpe.Vocabulary(bpe_file())
    texts = {r[0]: r[1] for r in rows["mix"]}
    assert len(rows["tokens"]) == len(rows["mix"])
    for r in held["tokens"].collect():
        assert r["n_tokens"] == len(r["ids"])
        assert vocabulary.decode(r["ids"]).decode() == texts[r["doc_id"]]
    for df in held.values():
        df.unpersist()


def bpe_file():
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def test_pipeline_takes_odd_documents(make_docs, odd_rows, spark, sf, monkeypatch):
    monkeypatch.setattr(language_gru, "STEPS", 5)
    docs = make_docs(odd_rows)
    for given in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            given = stage(spark, given, sf).persist()
            given.count()
            if name != "tokens":
                assert given.columns == docs.columns
