"""The classifier: held-out accuracy, plain dot products, plain updates."""

import math
import zlib

import numpy as np
import pytest

from ledgerlake.llm import classify
from ledgerlake.llm.common import table

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model(spark):
    return classify.train(table(spark, SF, "documents"), table(spark, SF, "labels"))


def auc(pairs):
    good, bad = [s for s, y in pairs if y], [s for s, y in pairs if not y]
    return sum((g > b) + 0.5 * (g == b) for g in good for b in bad) / (len(good) * len(bad))


def test_held_out_rows(spark, model):
    docs, labels = table(spark, SF, "documents"), {r.doc_id: r.quality for r in table(spark, SF, "labels").collect()}
    rows = classify.score(docs, model).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    unseen = [(r.score, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    assert len(unseen) > 100 and auc(unseen) > 0.97
    assert sum((s >= 0.5) == y for s, y in unseen) / len(unseen) > 0.95


def test_held_out_labels_are_not_read(spark, model):
    labels = table(spark, SF, "labels")
    import pyspark.sql.functions as F
    held = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3)) == 1
    turned = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    again = classify.train(table(spark, SF, "documents"), turned)
    assert np.allclose(again, model)


def test_score_is_a_plain_dot_product(model):
    texts = [None, "", "One one two!! 3 ###", "Ünï " * 50, "x"]
    f = classify.Features()
    got = f.dot(texts, model[:-1])
    for t, s, (place, value) in zip(texts, got, f.vectors(texts)):
        assert len(set(place.tolist())) == len(place)
        assert math.isclose(sum(model[p] * v for p, v in zip(place.tolist(), value.tolist())), s, abs_tol=1e-9)
    assert got[0] == got[1] == 0


def test_updates_follow_the_leader():
    """Against the closed form of one coordinate at a time."""
    m = classify.Ftrl(4)
    z, n = [0.0] * 5, [0.0] * 5
    rng = np.random.default_rng(1)
    for _ in range(50):
        place = np.unique(rng.integers(0, 4, 2))
        value, label = rng.random(len(place)), float(rng.integers(0, 2))
        m.learn(place, value, label)
        xs = [*zip(place.tolist(), value.tolist()), (4, 1.0)]
        w = {i: -z[i] / ((classify.BETA + math.sqrt(n[i])) / classify.ALPHA + classify.L2) for i, _ in xs}
        p = 1 / (1 + math.exp(-sum(w[i] * x for i, x in xs)))
        for i, x in xs:
            g = (p - label) * x
            z[i] += g - (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / classify.ALPHA * w[i]
            n[i] += g * g
    assert np.allclose(m.z, z) and np.allclose(m.n, n)


def rows_of(spark, rows):
    return spark.createDataFrame([(i, t, 5) for i, t in rows], "doc_id long, text string, score int")


def test_edges(spark):
    docs = rows_of(spark, [(0, "good words here"), (0, "good words here"), (2, "$$$ ### $$$"), (None, "good"), (3, None), (5, ""), (6, "$$$ ###")])
    labels = spark.createDataFrame([(0, 1), (2, 0), (2, 0), (None, 0), (3, None)], "doc_id long, quality int")
    for group_rows in (classify.GROUP_ROWS, 1):
        w = classify.train(docs, labels, group_rows=group_rows)
        got = [(r.doc_id, r.held_out, r.score) for r in classify.score(docs, w).collect()]
        assert len(got) == 7 and got[0] == got[1]
        by = {i: s for i, _, s in got}
        assert by[3] == by[5] == 1 / (1 + math.exp(-w[-1])) and by[0] > by[6]
        assert not [h for i, h, _ in got if i is None][0]


def test_empty_tables(spark):
    docs = rows_of(spark, [(1, "text"), (2, None)])
    none = spark.createDataFrame([], "doc_id long, quality int")
    got = classify.quality_scores(docs, none).collect()
    assert [(r.score, r.predicted) for r in got] == [(0.5, 1), (0.5, 1)]
    assert classify.quality_scores(docs.limit(0), none).count() == 0


def test_labels_beyond_the_broadcast_bound(spark, model, monkeypatch):
    monkeypatch.setattr(classify, "BROADCAST_LABELS", 0)
    again = classify.train(table(spark, SF, "documents"), table(spark, SF, "labels"))
    assert np.allclose(again, model)


def test_long_text_in_slices(monkeypatch):
    text = "some Words 12 !! " * 2000
    whole = classify.Features().vectors([text])[0]
    monkeypatch.setattr(classify, "SLICE_CHARS", 1000)
    parts = classify.Features().vectors([text])[0]
    assert whole[0].tolist() == parts[0].tolist() and np.allclose(whole[1], parts[1])
