"""Quality scores learned from preferences (Bradley-Terry), cut at a score quantile.

A document of the better label is preferred to one of the worse. The model gives each document a
score s(x) = w.f(x) and says P(a preferred to b) = 1 / (1 + exp(s(b) - s(a))): logistic loss on
feature differences, fitted by Newton's method. The cut is the quantile of the training scores
below which the worse label's share of documents lies; scores are reported as a logistic curve
that passes through `cut` at that quantile.

Features come from the text alone. Scale: one narrow pass makes the features, without a shuffle.
Every labelled training row is fitted. Few rows (`driver_rows` of each label) are fitted at the
driver, on `pairs` preferences drawn from them. More stay in Spark, where every pair of a better and
a worse row counts: tasks sum their rows by label and score, and as all rows of a score are preferred
alike, Newton's steps need these sums alone. The cut is an order statistic of all training scores.
Every document is scored, by an expression.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.llm.common import pack, stored, tune_arrow, unpack

FEATURES = (
    "log_words short_5 short_20 short_50 symbols pipes marks upper digits non_letters "
    "distinct_words top_word repeat_next repeat_trigram dup_lines dup_line_chars "
    "mean_word word_spread stop_chars deflate long_lines bullets urls"
).split()

URLS = re.compile(rb"https?://|www\.")


def byte_classes() -> np.ndarray:
    """A row of 0/1 for each class of bytes: symbols, pipes, marks, upper, digits, letters, heads.

    Bytes above ASCII count as letters where they begin a character; heads begin characters.
    """
    table = np.zeros((7, 256))
    for row, chars in enumerate((b"#*$%&<>{}\\^~=_@", b"|", b"!?")):
        table[row, list(chars)] = 1
    table[3, ord("A") : ord("Z") + 1] = 1
    table[4, ord("0") : ord("9") + 1] = 1
    table[5, ord("A") : ord("Z") + 1] = table[5, ord("a") : ord("z") + 1] = 1
    table[5, 0xC0:] = 1
    table[6, :0x80] = table[6, 0xC0:] = 1
    return table


CLASSES = byte_classes()


def features(text: str) -> list[float]:
    """Shares and logarithms of one text; finite for every text, empty ones too."""
    data = text.encode()
    words = data.split()
    n = len(words)
    at_least_one = max(1, n)
    size = max(1, len(data))
    bytes_seen = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    symbols, pipes, marks, upper, digits, letters, chars = (CLASSES @ bytes_seen).tolist()
    chars = max(1.0, chars)
    counts = Counter(words)
    lengths = np.fromiter(map(len, words), np.int64, n) if n else np.zeros(1, np.int64)
    lines = [x for x in data.split(b"\n") if x.strip()]
    line_counts = Counter(lines)
    dup_lines = len(lines) - len(line_counts)
    dup_chars = sum((c - 1) * len(x) for x, c in line_counts.items() if c > 1)
    trigrams = max(0, n - 2)
    distinct_trigrams = len(set(zip(words, words[1:], words[2:])))
    ends = sum(data.count(mark + gap) for mark in (b".", b",") for gap in (b" ", b"\n"))
    squeezed = len(zlib.compress(data, 1)) / size
    return [
        float(np.log1p(n)),
        float(np.exp(-n / 5)),
        float(np.exp(-n / 20)),
        float(np.exp(-n / 50)),
        min(2.0, symbols / at_least_one),
        min(2.0, pipes / at_least_one),
        min(2.0, marks / at_least_one),
        upper / max(1.0, letters),
        digits / chars,
        1 - letters / chars,
        len(counts) / at_least_one,
        max(counts.values()) / at_least_one if n else 0.0,
        sum(map(bytes.__eq__, words, words[1:])) / at_least_one,
        1 - distinct_trigrams / trigrams if trigrams else 0.0,
        dup_lines / max(1, len(lines)),
        dup_chars / size,
        min(40.0, float(lengths.mean())),
        min(40.0, float(lengths.std())),
        min(1.0, ends / at_least_one),
        min(1.0, squeezed) * min(1.0, n / 50),
        min(200.0, size / max(1, len(lines))) / 200,
        sum(x.lstrip()[:1] in (b"-", b"*", b"#", b">", b"|") for x in lines) / max(1, len(lines)),
        min(2.0, len(URLS.findall(data)) / at_least_one),
    ]


def text_features(text: Column) -> Column:
    """The features of a text column, as an array."""

    @F.pandas_udf("array<double>")
    def make(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([features(t or "") for t in texts], dtype=object)

    return make(text.cast("string"))


@dataclass(frozen=True)
class Ranker:
    """A fitted model: score = 1 / (1 + exp(-(w.z - offset))), z the features clipped after
    standardising."""

    mean: list[float]
    scale: list[float]
    weights: list[float]
    offset: float
    clip: float = 4.0

    def raw(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -self.clip, self.clip)
        return z @ np.asarray(self.weights)

    def score(self, features: Column) -> Column:
        """The score of a feature array, as an expression."""
        return 1 / (1 + F.exp(-self.linear(features)))

    def linear(self, features: Column) -> Column:
        """w.z - offset, as an expression."""
        total = F.lit(-self.offset)
        for i, (m, s, w) in enumerate(zip(self.mean, self.scale, self.weights)):
            z = F.greatest(
                F.lit(-self.clip), F.least(F.lit(self.clip), (features[i] - m) / F.lit(s))
            )
            total = total + F.lit(w) * z
        return total


def fit_pairs(better: np.ndarray, worse: np.ndarray, pairs: int, ridge: float, seed: int):
    """Weights from `pairs` random preferences: Newton's method on the pairwise logistic loss."""
    rng = np.random.default_rng(seed)
    n = max(pairs, 1)
    diff = better[rng.integers(0, len(better), n)] - worse[rng.integers(0, len(worse), n)]
    w = np.zeros(diff.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(diff @ w, -30, 30)))
        gradient = diff.T @ (1 - p) / n - ridge * w
        curve = (diff * (p * (1 - p))[:, None]).T @ diff / n + ridge * np.eye(len(w))
        step = np.linalg.solve(curve, gradient)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w


def bounded(rows: DataFrame, most: int) -> DataFrame:
    """At most `most` rows of each `_label`, those that come first by `_order`."""
    parts = [
        rows.filter(F.col("_label") == label).orderBy("_order").limit(most) for label in (0, 1)
    ]
    return parts[0].union(parts[1])


def sample_labels(marks: DataFrame, sample_rows: int, seed: int) -> DataFrame:
    """At most `sample_rows` rows (_label_id, _label) of each label, by smallest hash of the id."""
    order = F.struct(F.xxhash64(F.lit(seed), F.col("_label_id")), "_label_id").alias("_order")
    return bounded(marks.select("_label_id", "_label", order), sample_rows).drop("_order")


def fit(
    by_label: dict[int, np.ndarray],
    share: float,
    cut: float = 0.3,
    pairs: int = 60_000,
    ridge: float = 1e-3,
    seed: int = 20,
) -> Ranker:
    """A ranker from the feature rows of labels 0 and 1; `share` of all labels are 0.

    Without rows of both labels every document scores exactly `cut`.
    """
    at_cut = float(np.log(cut / (1 - cut)))
    if not len(by_label[0]) or not len(by_label[1]):
        k = len(FEATURES)
        return Ranker([0.0] * k, [1.0] * k, [0.0] * k, -at_cut)
    both = np.vstack([by_label[0], by_label[1]])
    mean, scale = both.mean(axis=0), both.std(axis=0)
    scale[scale < 1e-9] = 1.0
    unit = Ranker(mean, scale, [], 0.0)
    standard = {k: np.clip((x - mean) / scale, -unit.clip, unit.clip) for k, x in by_label.items()}
    weights = fit_pairs(standard[1], standard[0], pairs, ridge, seed)

    scores = np.concatenate([standard[0] @ weights, standard[1] @ weights])
    # The sample may hold the labels in other shares than the corpus: weigh the rows by that.
    mass = np.concatenate(
        [
            np.full(len(standard[0]), share / len(standard[0])),
            np.full(len(standard[1]), (1 - share) / len(standard[1])),
        ]
    )
    order = np.argsort(scores, kind="stable")
    at = min(int(np.searchsorted(np.cumsum(mass[order]), share - 1e-12)), len(order) - 1)
    after = min(at + 1, len(order) - 1)
    threshold = (scores[order][at] + scores[order][after]) / 2
    return Ranker(mean.tolist(), scale.tolist(), weights.tolist(), float(threshold - at_cut))


# Width of a score's bin in a fit of all pairs: rows of one bin are taken at their mean score.
BIN = 1 / 16


def binned_sums(rows: DataFrame, unit: Ranker, weights: np.ndarray) -> list:
    """(_label, _bin, sums) of all rows: sums of 1, score, z and z z' in each bin of the score.

    A score is at most `clip` times the sum of the absolute weights, so the bins are few however
    many rows there are.
    """
    k = len(weights)

    def summed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            x = np.array(batch["_features"].tolist(), dtype=float).reshape(-1, k)
            z = np.clip((x - unit.mean) / unit.scale, -unit.clip, unit.clip)
            scores = z @ weights
            keys = np.stack([batch["_label"].to_numpy(), np.floor(scores / BIN).astype(np.int64)])
            found, at = np.unique(keys, axis=1, return_inverse=True)
            for i, (label, place) in enumerate(found.T.tolist()):
                mine = np.flatnonzero(at.ravel() == i)
                part = np.concatenate(
                    [[len(mine), scores[mine].sum()], z[mine].sum(axis=0), (z[mine].T @ z[mine]).ravel()]
                )
                before = totals.get((label, place))
                totals[label, place] = part if before is None else before + part
        names = ["_label", "_bin", "_sums"]
        yield pd.DataFrame([(*key, v.tolist()) for key, v in totals.items()], columns=names)

    parts = rows.select("_label", "_features").mapInPandas(
        summed, "_label long, _bin long, _sums array<double>"
    )
    total = vector_to_array(Summarizer.sum(array_to_vector("_sums"))).alias("sums")
    return parts.groupBy("_label", "_bin").agg(total).collect()


def newton_step(sums: list, w: np.ndarray, ridge: float) -> np.ndarray:
    """One step of Newton's method on the mean loss of all pairs, from the sums of the bins."""
    k = len(w)
    n, score, z, square = {}, {}, {}, {}
    for label in (0, 1):
        mine = np.array([r["sums"] for r in sums if r["_label"] == label])
        n[label], score[label] = mine[:, 0], mine[:, 1] / mine[:, 0]
        z[label], square[label] = mine[:, 2 : 2 + k], mine[:, 2 + k :].reshape(-1, k, k)
    p = 1 / (1 + np.exp(-np.clip(score[1][:, None] - score[0][None, :], -30, 30)))
    pairs = n[0].sum() * n[1].sum()
    gradient = (z[1].T @ ((1 - p) @ n[0]) - z[0].T @ (n[1] @ (1 - p))) / pairs - ridge * w
    curve = p * (1 - p)
    cross = z[1].T @ curve @ z[0]
    hessian = (
        np.einsum("b,bij->ij", curve @ n[0], square[1])
        + np.einsum("b,bij->ij", n[1] @ curve, square[0])
        - cross
        - cross.T
    ) / pairs + ridge * np.eye(k)
    return np.linalg.solve(hessian, gradient)


def ranked_value(scores: DataFrame, rank: int) -> float:
    """The value of `_s` at place `rank` (from 0) of all rows, by counts in ever smaller bins."""
    low, high = scores.agg(F.min("_s"), F.max("_s")).head()
    while low < high:
        width = (high - low) / 1000
        place = F.floor((F.col("_s") - low) / width)
        within = scores.filter(F.col("_s").between(low, high)) if width else scores
        bins = within.groupBy(place.alias("b")).agg(
            F.count(F.lit(1)).alias("n"), F.min("_s").alias("lo"), F.max("_s").alias("hi")
        )
        for row in sorted(bins.collect(), key=lambda r: r["lo"]):
            if rank < row["n"]:
                if (row["lo"], row["hi"]) == (low, high):
                    return (low + high) / 2  # no double lies between
                low, high = row["lo"], row["hi"]
                break
            rank -= row["n"]
    return low


def fit_all(
    rows: DataFrame, n: dict[int, int], cut: float = 0.3, ridge: float = 1e-3, rounds: int = 30, **_
) -> Ranker:
    """A ranker from all stored rows (_label, _features), `n` of each label, and all their pairs."""
    k = len(FEATURES)
    at_cut = float(np.log(cut / (1 - cut)))
    spread = rows.agg(
        F.array(*[F.avg(F.col("_features")[i]) for i in range(k)]).alias("mean"),
        F.array(*[F.stddev_pop(F.col("_features")[i]) for i in range(k)]).alias("scale"),
    ).head()
    scale = [1.0 if v < 1e-9 else v for v in spread["scale"]]
    unit = Ranker(spread["mean"], scale, [], 0.0)
    w = np.zeros(k)
    for _ in range(rounds):
        step = newton_step(binned_sums(rows, unit, w), w, ridge)
        w = w + step
        if np.abs(step).max() < 1e-3:  # the bins tell no smaller ones apart
            break
    plain = Ranker(spread["mean"], scale, w.tolist(), 0.0)
    scores = stored(rows.select(plain.linear(F.col("_features")).alias("_s")))
    threshold = (ranked_value(scores, n[0] - 1) + ranked_value(scores, n[0])) / 2
    return Ranker(spread["mean"], scale, w.tolist(), float(threshold - at_cut))


def rank_quality(
    docs: DataFrame,
    labels: DataFrame,
    train: Column,
    label_col: str = "quality",
    id_col: str = "doc_id",
    text_col: str = "text",
    cut: float = 0.3,
    sample_rows: int | None = None,
    seed: int = 20,
    driver_rows: int = 2_000,
    **options,
) -> DataFrame:
    """`docs` with `score` (0 to 1, higher for the better label) and `kept` (score >= `cut`).

    `train` is a condition over `id_col`: labels of other rows are not read. All other labelled rows
    are fitted: at the driver up to `driver_rows` of each label, in Spark beyond. Only where
    `sample_rows` is given, so many rows of each label are, by hash of id and text. The cut quantile
    is the share of label 0 among all training rows. Labels, ids and all
    columns but the text stay out of the features. A null text scores as an empty one. A document
    without a label, or with a null one, is scored alike; different labels or
    texts of one id are several training rows, equal ones are one. Ties of the score at the cut stay. Equal texts get equal scores. Without training rows of both labels
    every score is `cut`. Other columns pass through; a column named like a result is replaced.
    Empty table: no rows.
    """
    tune_arrow(docs.sparkSession)
    texts = docs.select(F.col(id_col).alias("_id"), F.col(f"`{text_col}`").alias("_text"))
    marks = (
        labels.filter(train)
        .select(F.col(id_col).alias("_label_id"), F.col(label_col).cast("int").alias("_label"))
        .filter(F.col("_label").isin(0, 1))
        .join(texts.select("_id"), F.col("_label_id") == F.col("_id"), "left_semi")
    )
    if sample_rows is not None:
        # Bounded by the parameter: two longs for each of 2 * sample_rows rows.
        counts = {r["_label"]: r["count"] for r in marks.groupBy("_label").count().collect()}
        marks = F.broadcast(sample_labels(marks, sample_rows, seed))
    # An id may have any number of rows: one for each of its texts.
    drawn = (
        texts.join(marks, F.col("_id") == F.col("_label_id"))
        .withColumn("_th", F.xxhash64(F.coalesce("_text", F.lit(""))))
        .dropDuplicates(["_label_id", "_label", "_th"])
    )
    order = F.xxhash64(F.lit(seed), "_label_id", "_th").alias("_order")
    described = stored(
        drawn.select("_label", order, text_features(F.col("_text")).alias("_features"))
    )
    if sample_rows is None:
        counts = {r["_label"]: r["count"] for r in described.groupBy("_label").count().collect()}
    n = {label: counts.get(label, 0) for label in (0, 1)}
    most = driver_rows if sample_rows is None else sample_rows
    if sample_rows is None and max(n.values()) > most and min(n.values()):
        ranker = fit_all(described, n, cut, **options)
    else:
        # One label alone fits nothing, whatever its number of rows.
        rows = bounded(described, most).toPandas().sort_values(["_label", "_order"])
        by_label = {
            k: np.array(rows["_features"][rows["_label"] == k].tolist(), dtype=float).reshape(
                -1, len(FEATURES)
            )
            for k in (0, 1)
        }
        ranker = fit(by_label, n[0] / max(1, sum(n.values())), cut, seed=seed, **options)
    scored = docs.select(pack(docs), text_features(F.col(f"`{text_col}`")).alias("_features"))
    scored = scored.withColumn("_score", ranker.score(F.col("_features")))
    return unpack(
        scored, docs.columns, score=F.col("_score"), kept=F.col("_score") >= F.lit(cut)
    )
