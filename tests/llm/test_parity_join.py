import random
import re

import numpy as np
import pytest
from conftest import plan_of
from helpers import DOCS, brute_components, docs_frame, near_copies, random_words, shingle_set

from marketlake.llm import common
from marketlake.llm import parity_join as pj


def check(spark, rows, **options):
    df = docs_frame(spark, rows)
    got = pj.jaccard_classes(df, **options).collect()
    want = brute_components(rows, options.get("percent", 80))
    assert len(got) == len(rows)
    assert {(r.doc_id, r.component_id) for r in got if r.doc_id is not None} == set(want.items())
    sizes = sorted((str(r.doc_id), r.n_shingles) for r in got)
    assert sizes == sorted((str(i), len(shingle_set(t))) for i, t in rows)


def test_equals_brute_force(spark):
    texts = near_copies(1)
    random.Random(1).shuffle(texts)
    check(spark, list(enumerate(texts)))


def test_other_threshold(spark):
    check(spark, list(enumerate(near_copies(5)[:160])), percent=90)


def test_a_chain_of_near_copies_is_one_component(spark):
    rng = random.Random(7)
    text, rows = random_words(rng, 200), []
    for i in range(40):
        rows.append((39 - i, " ".join(text)))
        at = rng.randrange(len(text))
        text = text[:at] + [f"y{i}"] + text[at + 1 :]
    check(spark, rows)


def test_contested_keys(spark, monkeypatch):
    """Documents that share a passage only, in blocks of a few members."""
    monkeypatch.setattr(pj, "BLOCK", 4)
    rng = random.Random(9)
    passage = random_words(rng, 70)
    rows = []
    for i in range(30):
        head = random_words(rng, 12, 10**6)
        rows.append((2 * i, " ".join(head + passage)))
        rows.append((2 * i + 1, " ".join(head[:-1] + ["z"] + passage)))
    check(spark, rows)


def boilerplate_rows(n=60):
    """Documents with one passage in common, half of them with a near copy, one a copy of it alone."""
    rng = random.Random(11)
    passage = random_words(rng, 40)
    rows = []
    for i in range(n):
        own = random_words(rng, rng.choice([300, 340]), 10**6)
        rows.append((2 * i, " ".join(own + passage)))
        if i % 2:
            rows.append((2 * i + 1, " ".join(["z"] + own[1:] + passage)))
    return [*rows, (1000, " ".join(passage))]


def test_a_shared_passage_makes_no_crowd(spark, monkeypatch):
    """Pairs are enumerated by keys of few documents, though all of them share a passage."""
    monkeypatch.setattr(pj, "CROWD", 8)
    crowds, enumerated = [], pj.ParityJoin.enumerated

    def watched(self, members, classes, found):
        crowds.append(max((r["count"] for r in members.groupBy("key").count().collect()), default=0))
        return enumerated(self, members, classes, found)

    monkeypatch.setattr(pj.ParityJoin, "enumerated", watched)
    check(spark, boilerplate_rows())
    assert crowds and crowds[0] < 8


@pytest.mark.parametrize("rounds, crowded", [(1, 3), (3, 5), (3, 10**5)])
def test_crowded_keys_lose_no_link(spark, monkeypatch, rounds, crowded):
    """Without links found before, whatever part of the crowded keys is put last."""
    monkeypatch.setattr(pj, "CROWD", 2)
    monkeypatch.setattr(pj, "CROWDED", crowded)
    monkeypatch.setattr(pj, "ROUNDS", rounds)
    monkeypatch.setattr(pj, "BRIDGES", 0)
    check(spark, boilerplate_rows(20) + [(2000 + i, t) for i, t in enumerate(near_copies(2)[:120])])


def keyed_again(monkeypatch):
    """The numbers of documents that are keyed again, filled as the join runs."""
    counts, again = [], pj.ParityJoin.keyed_again

    def watched(self, rows, exact_levels, late):
        counts.append(rows.count())
        return again(self, rows, exact_levels, late)

    monkeypatch.setattr(pj.ParityJoin, "keyed_again", watched)
    return counts


def cluster_rows(n_near, n_alone, seed=13):
    """Documents with one passage in common: near copies of one, all linked, and others."""
    rng = random.Random(seed)
    passage, body = random_words(rng, 200), random_words(rng, 80, 10**6)
    near = [" ".join([f"v{i}"] + body[1:] + passage) for i in range(n_near)]
    alone = [" ".join(random_words(rng, 80, 10**6) + passage) for _ in range(n_alone)]
    return list(enumerate(near + alone))


def test_one_large_component_is_not_keyed_again(spark, monkeypatch):
    """Few others share a key with it: they are compared, and its documents keep their keys."""
    monkeypatch.setattr(pj, "CROWD", 8)
    counts = keyed_again(monkeypatch)
    check(spark, cluster_rows(30, 4))
    assert not counts
    check(spark, cluster_rows(30, 20))  # the others are a crowd
    assert counts


def test_some_hundred_documents_of_a_passage_are_not_keyed_again(spark, monkeypatch):
    """No more keys are made for 250 documents of one passage: one task can compare them."""
    counts = keyed_again(monkeypatch)
    check(spark, cluster_rows(0, 250))
    assert not counts


def test_those_outside_the_largest_component_meet_all_in_blocks(spark, monkeypatch):
    """Without links by bridges, in many blocks of both sides; each pair once."""
    monkeypatch.setattr(pj, "BLOCK", 3)
    monkeypatch.setattr(pj, "BRIDGES", 0)
    rows = cluster_rows(12, 8) + [(100 + i, t) for i, t in enumerate(near_copies(6)[:120])]
    check(spark, rows + [(1000 + i, t) for i, t in boilerplate_rows(12)])


@pytest.mark.parametrize("n_late", [0, 1, 40, 100])
def test_leading_keys(n_late):
    rng = np.random.default_rng(n_late)
    keys = np.unique(rng.integers(0, 2**64, 100, np.uint64))
    late = np.sort(np.r_[rng.permutation(keys)[:n_late], rng.integers(0, 2**64, 5, np.uint64)])
    order = sorted(rng.permutation(keys), key=lambda k: (k in late, k))
    for count in (1, 30, 99, 100, 120):
        assert set(pj.leading(rng.permutation(keys), count, late)) == set(order[:count])


def test_edge_rows(spark):
    rows = [(0, None), (1, ""), (2, " \n"), (3, "a"), (4, "A"), (None, "a"), (5, "a"), (5, "b c"),
            (6, "b C"), (7, "x " * 3000), (8, "x " * 4000)]
    check(spark, rows)
    empty = pj.jaccard_classes(spark.createDataFrame([], DOCS))
    assert empty.count() == 0 and empty.columns == ["doc_id", "n_shingles", "class_id", "component_id"]
    with pytest.raises(ValueError):
        pj.jaccard_classes(docs_frame(spark, ["a"]), percent=50)


def test_clashing_columns(spark):
    df = docs_frame(spark, ["a b", "A b"], ["1 as _id", "2 as key", "3 as component_id", "4 as n"])
    assert {r.component_id for r in pj.jaccard_classes(df).collect()} == {0}


def test_class_is_the_smallest_id_of_the_same_set(spark):
    df = docs_frame(spark, [(9, "p q r"), (4, "P q  r"), (7, "other")])
    assert {r.doc_id: r.class_id for r in pj.jaccard_classes(df).collect()} == {9: 4, 4: 4, 7: 7}


@pytest.mark.parametrize("size", [1, 4, 20, 63, 64, 100, 127, 128, 200, 1000])
def test_linked_sets_share_a_key_and_pass_the_sketch(size):
    """At the largest difference that a link allows, in both size orders."""
    rng = np.random.default_rng(size)
    for _ in range(20):
        a = np.unique(rng.integers(0, 2**64, size, np.uint64))
        n = len(a)
        most = pj.max_difference(n, 80)
        gone = int(rng.integers(0, most // 2 + 1))
        b = np.unique(np.r_[a[gone:], rng.integers(0, 2**64, most - gone, np.uint64)])
        both = len(np.intersect1d(a, b))
        if 100 * both < 80 * (len(a) + len(b) - both):
            continue

        def keys(x):
            found = set()
            for level, limit in pj.levels(len(x), 80):
                k = pj.level_keys(x, level, 80, False)
                assert len(k) > limit
                found.update(np.sort(k)[: limit + 1].tolist())
            return found

        assert keys(a) & keys(b)
        x, y = sorted((pj.sketch(a).view(pj.U), pj.sketch(b).view(pj.U)), key=len)
        if len(y) > len(x):
            assert len(y) == 2 * len(x)
            y = y[: len(x)] ^ y[len(x) :]
        assert np.bitwise_count(x ^ y).sum() <= len(np.setxor1d(a, b))


def test_bands_with_too_few_keys_fall_back_to_elements(spark, monkeypatch):
    monkeypatch.setattr(pj, "SPARE", 0.5)  # far too few buckets
    check(spark, list(enumerate(near_copies(3)[:200])))


def test_each_task_has_one_python_worker(spark, monkeypatch):
    """Keys are made and dealt by one Python step, also where documents are keyed again."""
    monkeypatch.setattr(pj, "CROWD", 8)
    plans, stored = [], pj.stored

    def watched(df):
        plans.append(plan_of(df))
        return stored(df)

    monkeypatch.setattr(pj, "stored", watched)
    again = []
    monkeypatch.setattr(pj.ParityJoin, "uncrowded", lambda *a, f=pj.ParityJoin.uncrowded: (
        again.append(len(plans)), f(*a))[1])
    check(spark, boilerplate_rows())
    assert again and any("MapInArrow" in p for p in plans[again[0] :])
    for plan in plans:
        tasks = re.split("Exchange|Scan", plan)  # what runs together lies between these
        assert max(t.count("MapInArrow") for t in tasks) <= 1


@pytest.mark.parametrize("size", [100, 300, 1000, 1023, 1024, 5000])
def test_sketches_are_short_and_tell_sets_apart(size):
    """Two bits an element at most; sets that differ by half of their elements are told apart."""
    rng = np.random.default_rng(size)
    a, b = (np.unique(rng.integers(0, 2**64, size, np.uint64)) for _ in range(2))
    b = np.unique(np.r_[a[size // 4 :], b[: size // 4]])  # half of `size` elements differ
    x, y = pj.sketch(a).view(pj.U), pj.sketch(b).view(pj.U)
    assert 64 * len(x) <= 2 * size
    distance = int(np.bitwise_count(x ^ y).sum())
    assert distance * 180 > 20 * (len(a) + len(b))


def test_texts_are_picked_without_a_shuffle_or_with_one(spark, monkeypatch):
    """Beyond `LISTED` ids the texts are joined by a shuffle, with the same result."""
    monkeypatch.setattr(common, "LISTED", 0)
    check(spark, list(enumerate(near_copies(4)[:150])))
