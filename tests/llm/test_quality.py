"""Line CRF and host rules."""

from __future__ import annotations

import itertools
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from curbside.llm import quality_crf as crf
from curbside.llm import quality_rules as rules
from curbside.llm.text import table
from tests_llm_helpers import as_rows


def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(3)
    doc = np.array([0, 0, 0, 0, 1, 2, 2])
    s, t = rng.normal(size=7), rng.normal(size=(2, 2))
    left, right = crf.forward_backward(s, crf._chains(doc), t)
    for number in range(3):
        places = np.flatnonzero(doc == number)
        weight = np.zeros((len(places), 2))
        for labels in itertools.product((0, 1), repeat=len(places)):
            score = sum(s[p] * y for p, y in zip(places, labels))
            score += sum(t[a, b] for a, b in zip(labels, labels[1:]))
            for i, y in enumerate(labels):
                weight[i, y] += np.exp(score)
        exact = np.log(weight[:, 1] / weight[:, 0])
        assert np.allclose(left[places] + right[places], exact)


def test_gradient_equals_difference():
    rng = np.random.default_rng(4)
    doc = np.array([0, 0, 0, 1, 1])
    x, y = rng.normal(size=(5, 3)), np.array([1.0, 1, 1, 0, 0])
    chains = crf._chains(doc)

    def likelihood(theta):
        w, t = theta[:3], theta[3:].reshape(2, 2)
        s, total = x @ w, 0.0
        for number in (0, 1):
            places = np.flatnonzero(doc == number)
            paths = []
            for labels in itertools.product((0, 1), repeat=len(places)):
                score = sum(s[p] * v for p, v in zip(places, labels))
                paths.append(score + sum(t[a, b] for a, b in zip(labels, labels[1:])))
                if list(labels) == list(y[places]):
                    total += paths[-1]
            total -= np.log(np.exp(paths).sum())
        return total

    theta = rng.normal(size=7)
    dw, dt = crf._gradient(x, y, chains, theta[:3], theta[3:].reshape(2, 2))
    step = 1e-6
    numeric = [
        (likelihood(theta + step * e) - likelihood(theta - step * e)) / (2 * step) for e in np.eye(7)
    ]
    assert np.allclose(np.append(dw, dt.ravel()), numeric, atol=1e-5)


def test_line_features_of_known_lines():
    lines = crf.line_features(pa.array(["ab ab\n\nAB 1!\nab ab", None, "", "x"], pa.large_string()))
    assert lines.doc.tolist() == [0, 0, 0, 3]
    distinct, stutter, copied = lines.x[:, -3], lines.x[:, -2], lines.x[:, -1]
    assert distinct.tolist() == [0.5, 1.0, 0.5, 1.0]
    assert stutter.tolist() == [0.5, 0.0, 0.5, 0.0]
    assert copied.sum() <= 1
    assert lines.x[1, crf._UPPER] == 2 / 6


def test_held_out_accuracy(spark, sf):
    docs, labels = table(spark, "/root/testdata/sf0.01", "documents"), table(spark, "/root/testdata/sf0.01", "labels")
    scored = crf.score_quality(docs, labels).join(labels.where("quality is not null"), "doc_id").toPandas()
    held = scored[scored.held_out]
    assert (held.predicted == held.quality).mean() > 0.95
    assert all(zlib.crc32(str(i).encode()) % 5 == 0 for i in held.doc_id)


def test_odd_documents_get_scores(spark, make_docs, odd_rows):
    labels = spark.createDataFrame([(4, 1), (5, 0), (6, 1), (None, 1), (7, None)], "doc_id long, quality int")
    docs = make_docs(odd_rows)
    for held_labels in (labels, labels.limit(0), labels.where("quality = 1")):
        rows = crf.score_quality(docs, held_labels).collect()
        assert len(rows) == len(odd_rows)
        assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in rows)
        empties = {r["score"] for r in rows if r["doc_id"] in (1, 2, 3, 10)}
        assert len(empties) == 1
    assert crf.score_quality(docs.limit(0), labels).count() == 0


def brute_measures(text):
    text = text or ""
    words = text.encode().split()
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(8)}
    lines = [line for line in text.split("\n") if line.encode().split()]
    return (
        len(words),
        sum(len(w.decode()) for w in words),
        sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)),
        len(covered),
    )


def test_rules_equal_brute_force(make_docs, odd_rows):
    rows = [r for r in odd_rows if not r[1] or len(r[1]) < 5_000]
    rows += [(20, "a b c d e f g h a b c d e f g h i " * 3, "en", "d"), (21, "x\nx\n y\n\nx #$", "en", "d")]
    result = rules.host_rules(make_docs(rows)).collect()
    found = sorted((r["doc_id"] or 0, *r[1:6], r["base_failed"]) for r in result)
    expected = []
    for doc, text, *_ in rows:
        m = brute_measures(text)
        expected.append((doc or 0, *m, m[0] < 20 or 100 * m[4] > 30 * m[0]))
    assert found == sorted(expected)


def test_long_repetition_and_empty_table(make_docs):
    docs = make_docs([(1, "the of and to " * 40_000, "en", "a")])
    row = rules.host_rules(docs).first()
    assert row["n_words"] == row["n_repeat_words"] == 160_000 and row["base_failed"]
    assert rules.host_rules(docs.limit(0)).count() == 0


def test_bad_hosts_take_their_documents_along(make_docs):
    good = " ".join(f"w{i}" for i in range(30))
    rows = [(i, "short", "en", "bad.example") for i in range(80)]
    rows += [(100 + i, good + f" {i}", "en", "bad.example") for i in range(20)]
    rows += [(200 + i, good + f" {i}", "en", None) for i in range(300)]
    result = {r["doc_id"]: r for r in rules.host_rules(make_docs(rows)).collect()}
    assert all(result[100 + i]["host_failed"] and not result[100 + i]["kept"] for i in range(20))
    assert all(result[200 + i]["kept"] for i in range(300))


def test_shrinking_pulls_small_hosts_to_the_mean(spark):
    measured = spark.createDataFrame(
        [("one", True)] + [(f"h{i}", j % 10 == 0) for i in range(30) for j in range(50 + i)],
        "host string, base_failed boolean",
    )
    rates = {r["host"]: r for r in rules.host_rates(measured).collect()}
    assert rates["one"]["rate"] < 0.9 < rates["one"]["failed"] / rates["one"]["n"]


def test_rules_query_equals_sql(spark, sf):
    duck = duckdb.connect()
    duck.execute(f"create view documents as select * from '{sf}/documents.parquet'")
    answer = duck.execute(rules.SQL)
    names = [c[0] for c in answer.description]
    result = rules.host_rules(table(spark, sf, "documents")).select(*names)
    assert as_rows(result.collect()) == as_rows(answer.fetchall())


def test_chance_does_not_pass_for_a_spread(spark):
    rows = [(f"h{i}", (7 * i + 3 * j) % 10 < 3) for i in range(40) for j in range(1 + i % 4)]
    rates = rules.host_rates(spark.createDataFrame(rows, "host string, base_failed boolean")).collect()
    mean = sum(f for _, f in rows) / len(rows)
    assert max(r["rate"] for r in rates) - min(r["rate"] for r in rates) < 0.25 and {r["n"] for r in rates} == {1, 2, 3, 4}
    alone = spark.createDataFrame([(f"h{i}", i < 3) for i in range(10)], "host string, base_failed boolean")
    assert {round(r["rate"], 12) for r in rules.host_rates(alone).collect()} == {0.3} and 0 < mean < 1


def test_hosts_fail_by_each_rule_as_in_sql(make_docs, tmp_path):
    good = [" ".join(f"w{i}x{j}" for i in range(30)) for j in range(400)]
    rows = [(i, "too short", "en", "short.example") for i in range(30)]
    rows += [(100 + i, good[i] + " # # # # & &", "en", "marks.example") for i in range(40)]
    rows += [(200 + i, "\n".join([good[i], "one line", "one line", "one line"]), "en", "lines.example") for i in range(40)]
    rows += [(300 + i, good[i], "en", host) for i, host in enumerate(["short.example", "marks.example", "lines.example"] * 4)]
    rows += [(400 + i, good[i], "en", None if i % 2 else "fine.example") for i in range(200)]
    rows += [(700, "# # #", "en", "one.example"), (701, None, None, "none.example"), (702, "", "en", None)]
    docs = make_docs(rows)
    docs.write.parquet(str(tmp_path / "docs"))
    duck = duckdb.connect()
    duck.execute(f"create view documents as select * from '{tmp_path}/docs/*.parquet'")
    answer = duck.execute(rules.SQL)
    names = [c[0] for c in answer.description]
    result = rules.host_rules(docs)
    assert as_rows(result.select(*names).collect()) == as_rows(answer.fetchall())
    kept = {r["doc_id"]: r["kept"] for r in result.collect()}
    assert not any(kept[i] for i in kept if i < 400)
    assert all(kept[i] for i in range(400, 600))


@pytest.mark.parametrize("words", range(0, 12))
def test_windows_of_short_texts(make_docs, words):
    row = rules.host_rules(make_docs([(1, " ".join("a" * words), "en", "a")])).first()
    assert row["n_repeat_words"] == brute_measures(" ".join("a" * words))[4]


def test_long_texts_teach_by_a_stretch(spark):
    from pyspark.sql import functions as F

    from curbside.llm.text import stretch

    long = "".join(f"{i:05d}" for i in range(400))
    table = spark.createDataFrame([(i, long) for i in range(50)] + [(50, "short"), (51, ""), (52, None)], "doc_id long, text string")
    cut = {r[0]: r[1] for r in table.select("doc_id", stretch(F.col("text"), F.col("doc_id"), 100)).collect()}
    assert (cut[50], cut[51], cut[52]) == ("short", "", None)
    assert all(len(cut[i]) == 100 and cut[i] in long for i in range(50)) and len({cut[i] for i in range(50)}) > 40
    labels = spark.createDataFrame([(i, i % 2) for i in range(50)], "doc_id long, quality int")
    rows = crf.training_sample(table, labels, lambda key: F.lit(True))
    assert len(rows) == 50 and all(r["text"] in long for r in rows)


def test_lines_that_teach_are_bounded(spark, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(crf, "TRAIN_LINES", 3)
    table = spark.createDataFrame([(1, "a\nb\nc\nd\ne"), (2, "x")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0), (2, 1)], "doc_id long, quality int")
    assert {r["text"] for r in crf.training_sample(table, labels, lambda key: F.lit(True))} == {"a\nb\nc", "x"}
