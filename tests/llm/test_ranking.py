import math
import random

import numpy as np
from helpers import DOCS, docs_frame, random_words
from pyspark.sql import functions as F

from marketlake.llm import ranking
from marketlake.llm.ranking import FEATURES, features, fit_pairs, rank_quality

LABELS = "doc_id long, quality int, toxic int"


def corpus(n=300):
    rng = random.Random(1)
    rows, labels = [], []
    for i in range(n):
        good = rng.random() < 0.7
        w = random_words(rng, rng.randrange(60, 200))
        text = " ".join(w) if good else " ".join(f"{x}###" for x in w)
        rows.append((i, text))
        labels.append((i, int(good), 0))
    return rows, labels


def test_held_out_accuracy_and_columns(spark):
    rows, labels = corpus()
    marks = spark.createDataFrame(labels, LABELS)
    got = rank_quality(docs_frame(spark, rows), marks, train=F.col("doc_id") % 5 != 0).collect()
    truth = {i: q for i, q, _ in labels}
    held = [r for r in got if r.doc_id % 5 == 0]
    assert np.mean([r.kept == bool(truth[r.doc_id]) for r in held]) > 0.95
    assert all(0 <= r.score <= 1 and r.kept == (r.score >= 0.3) for r in got)


def test_labels_of_other_rows_are_not_read(spark):
    rows, labels = corpus(120)
    df, train = docs_frame(spark, rows), F.col("doc_id") % 5 != 0
    flipped = [(i, q if i % 5 else 1 - q, t) for i, q, t in labels]
    one = rank_quality(df, spark.createDataFrame(labels, LABELS), train=train).collect()
    two = rank_quality(df, spark.createDataFrame(flipped, LABELS), train=train).collect()
    assert {r.doc_id: r.score for r in one} == {r.doc_id: r.score for r in two}


def test_pairwise_fit_is_the_maximum(spark):
    """The gradient of the regularised pairwise loss vanishes at the weights."""
    rng = np.random.default_rng(3)
    better, worse = rng.normal(0.3, 1, (200, 4)), rng.normal(0, 1, (150, 4))
    w = fit_pairs(better, worse, 5000, 1e-3, 9)
    again = np.random.default_rng(9)
    diff = better[again.integers(0, 200, 5000)] - worse[again.integers(0, 150, 5000)]
    gradient = diff.T @ (1 / (1 + np.exp(diff @ w))) / 5000 - 1e-3 * w
    assert np.abs(gradient).max() < 1e-8
    assert (w > 0).all()


def test_cut_is_the_quantile_of_the_worse_label():
    rng = np.random.default_rng(4)
    by = {k: rng.normal(2.0 * k, 1.0, (400, len(FEATURES))) for k in (0, 1)}
    model = ranking.fit(by, 0.25)
    raw = {k: model.raw(x) - model.offset for k, x in by.items()}
    below = sum(np.mean(raw[k] < math.log(0.3 / 0.7)) * share for k, share in ((0, 0.25), (1, 0.75)))
    assert abs(below - 0.25) < 0.01


def test_features_are_finite_for_any_text():
    for text in ["", " ", "\n\n", "a", "|||", "é" * 50, "x" * 200_000, "\x00", "日本 " * 60]:
        values = features(text)
        assert len(values) == len(FEATURES) and all(math.isfinite(v) for v in values)


def test_edge_rows(spark):
    rows, labels = corpus(60)
    rows += [(1000, None), (1001, ""), (None, "no id"), (1, rows[1][1]), (2, "a second text of id 2")]
    labels += [(1000, 0, None), (5000, 1, 0), (None, 1, 0), (3, None, 0), (1, 1, 0)]
    marks = spark.createDataFrame(labels, LABELS)
    got = rank_quality(docs_frame(spark, rows), marks, train=F.lit(True)).collect()
    assert len(got) == len(rows) and all(r.score is not None and r.kept is not None for r in got)
    by_text = {}
    for r in got:
        assert by_text.setdefault(r.text or "", r.score) == r.score


def test_one_label_or_none_and_empty_tables(spark):
    rows, labels = corpus(20)
    df = docs_frame(spark, rows, ["'f' as _features", "9 as _label", "'s' as score"])
    ones = spark.createDataFrame([(i, 1, 0) for i, _, _ in labels], LABELS)
    for marks in (ones, ones.limit(0)):
        got = rank_quality(df, marks, train=F.lit(True)).collect()
        assert {round(r.score, 9) for r in got} == {0.3} and all(r.kept for r in got)
        assert {(r._features, r._label) for r in got} == {("f", 9)}
    assert rank_quality(spark.createDataFrame([], DOCS), ones, train=F.lit(True)).count() == 0


def test_scores_equal_a_plain_computation(spark, monkeypatch):
    """Features, sample, preferences, fit and cut again, by plain loops."""
    rows, labels = corpus(90)
    rows += [(1000, None), (1001, "")]
    made = []
    fit = ranking.fit
    monkeypatch.setattr(ranking, "fit", lambda *a, **k: made.append((a, k, fit(*a, **k))) or made[-1][2])
    marks = spark.createDataFrame(labels, LABELS)
    got = rank_quality(docs_frame(spark, rows), marks, train=F.col("doc_id") % 5 != 0).collect()
    (by_label, share, cut), _, model = made[0]
    texts, truth = dict(rows), {i: q for i, q, _ in labels if i % 5}
    for label in (0, 1):
        want = sorted(features(texts[i]) for i, q in truth.items() if q == label)
        assert np.allclose(sorted(by_label[label].tolist()), want)
    assert share == sum(q == 0 for q in truth.values()) / len(truth)

    both = np.array(by_label[0].tolist() + by_label[1].tolist())
    mean, spread = both.mean(axis=0), both.std(axis=0)
    spread[spread < 1e-9] = 1.0

    def clipped(x):
        return [max(-4.0, min(4.0, (v - m) / s)) for v, m, s in zip(x, mean, spread)]

    # Newton's steps on the loss of the same preferences.
    rng = np.random.default_rng(20)
    worse, better = ([clipped(x) for x in by_label[k]] for k in (0, 1))
    left, right = rng.integers(0, len(better), 60_000), rng.integers(0, len(worse), 60_000)
    diff = np.array([better[a] for a in left]) - np.array([worse[b] for b in right])
    w = np.zeros(len(FEATURES))
    for _ in range(60):
        p = 1 / (1 + np.exp(-diff @ w))
        gradient = diff.T @ (1 - p) / len(diff) - 1e-3 * w
        curve = (diff * (p * (1 - p))[:, None]).T @ diff / len(diff) + 1e-3 * np.eye(len(w))
        w = w + np.linalg.solve(curve, gradient)
    assert np.allclose(w, model.weights, atol=1e-5)
    for r in got:
        raw = sum(a * b for a, b in zip(clipped(features(r.text or "")), model.weights))
        assert abs(r.score - 1 / (1 + math.exp(model.offset - raw))) < 1e-9


def test_one_labelled_id_on_many_rows_is_bounded(spark, monkeypatch):
    rows, labels = corpus(60)
    rows += [(3, f"text {k} of id 3") for k in range(3000)] + [(4, "the same text")] * 500
    made = []
    fit = ranking.fit
    monkeypatch.setattr(ranking, "fit", lambda by, *a, **k: made.append(by) or fit(by, *a, **k))
    marks = spark.createDataFrame(labels, LABELS)
    got = rank_quality(docs_frame(spark, rows), marks, train=F.lit(True), sample_rows=10)
    assert got.count() == len(rows)
    assert all(len(x) == 10 for x in made[0].values())


def test_ties_at_the_cut_stay():
    by = {k: np.full((50, len(FEATURES)), 1.0) for k in (0, 1)}
    model = ranking.fit(by, 0.5)
    raw = model.raw(by[0][:1])[0] - model.offset
    assert 1 / (1 + math.exp(-raw)) >= 0.3 - 1e-12


def test_many_rows_are_all_fitted_in_spark(spark, monkeypatch):
    """Beyond the driver's rows: weights are the maximum over all pairs, the cut lies behind the
    worse rows' share of all scores."""
    rows, labels = corpus(260)
    rows += [(i, rows[i][1]) for i in range(20)] + [(1000, None)]
    labels += [(i, 1 - q, t) for i, q, t in labels[:30]]  # the labels overlap
    monkeypatch.setattr(ranking, "fit", None)
    made, fit_all = [], ranking.fit_all
    monkeypatch.setattr(ranking, "fit_all", lambda *a, **k: made.append(fit_all(*a, **k)) or made[-1])
    marks = spark.createDataFrame(labels, LABELS)
    train = F.col("doc_id") % 5 != 0
    got = rank_quality(docs_frame(spark, rows), marks, train=train, driver_rows=20).collect()
    assert len(got) == len(rows)
    texts = dict(rows[:260])
    by = {k: np.array([features(texts[i]) for i, q, _ in labels if i % 5 and q == k]) for k in (0, 1)}
    both, model = np.vstack([by[0], by[1]]), made[0]
    assert np.allclose(model.mean, both.mean(axis=0))
    spread = both.std(axis=0)
    assert np.allclose(model.scale, np.where(spread < 1e-9, 1.0, spread))
    z = {k: np.clip((x - model.mean) / model.scale, -4, 4) for k, x in by.items()}
    diff = (z[1][:, None, :] - z[0][None, :, :]).reshape(-1, len(FEATURES))
    w = np.array(model.weights)
    gradient = diff.T @ (1 / (1 + np.exp(diff @ w))) / len(diff) - 1e-3 * w
    assert np.abs(gradient).max() < 2e-3
    both_scores = np.concatenate([z[0] @ w, z[1] @ w])
    raw = np.sort(both_scores)
    n = len(by[0])
    assert abs((raw[n - 1] + raw[n]) / 2 - (model.offset + math.log(0.3 / 0.7))) < 1e-9
    kept = 1 / (1 + np.exp(model.offset - both_scores)) >= 0.3
    assert abs(int((~kept).sum()) - n) <= 1


def test_ranked_values_with_ties(spark):
    rng = random.Random(2)
    values = [rng.choice([0.0, 1e-300, 0.1, 0.1 + 1e-16, 5.0, -3.0, rng.random()]) for _ in range(500)]
    scores = spark.createDataFrame([(v,) for v in values], "_s double")
    for rank in (0, 1, 137, 250, 498, 499):
        assert ranking.ranked_value(scores, rank) == sorted(values)[rank]
