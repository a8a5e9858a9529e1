import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from helpers import DOCS, docs_frame, lower

from marketlake.llm import spelling_trie as st

WORDS = "word string, n long"


def edits(word, letters):
    for i in range(len(word) + 1):
        for c in letters:
            yield word[:i] + c + word[i:]
        if i < len(word):
            yield word[:i] + word[i + 1 :]
            for c in letters:
                yield word[:i] + c + word[i + 1 :]


def brute_groups(counts):
    """word -> (n, form, root, n_near, form_n), by trying all edits of a word."""
    letters = sorted(set("".join(counts)))
    forms, out = {}, {}
    for word, n in counts.items():
        near = {e for e in edits(word, letters) if e in counts and e != word}
        best = min(near, key=lambda w: (-counts[w], w), default=None)
        form = best if best is not None and counts[best] >= 10 * n else None
        forms[word] = form
        out[word] = [n, form, word, len(near), counts[form] if form else None]
    for word in out:
        root = word
        while forms[root] is not None:
            root = forms[root]
        out[word][2] = root
    return {w: tuple(v) for w, v in out.items()}


def groups(spark, counts, **blocks):
    df = spark.createDataFrame(list(counts.items()), WORDS)
    rows = st.spelling_groups(df, **blocks).collect()
    assert len(rows) == len(counts)
    return {r.word: (r.n, r.form, r.root, r.n_near, r.form_n) for r in rows}


def vocabulary(rng, bases, alphabet="abcdeéÿxyz"):
    counts = {}
    for _ in range(bases):
        word = "".join(rng.choice(alphabet) for _ in range(rng.randrange(7, 12)))
        n = rng.choice([2, 9, 40, 500, 5000, 60_000])
        for _ in range(rng.randrange(6)):
            counts.setdefault(word, n)
            word = rng.choice(list(edits(word, alphabet)))
            n = max(2, n // rng.choice([1, 3, 10, 12]))
    return {w: n for w, n in counts.items() if len(w) >= 7}


def test_equals_brute_force(spark):
    counts = vocabulary(random.Random(1), 300)
    assert groups(spark, counts) == brute_groups(counts)


@pytest.mark.parametrize("levels", [1, 7, 12])
def test_levels_and_blocks_change_nothing(spark, levels):
    """Few letters make large leaves, cut into many blocks of words and of queries."""
    counts = vocabulary(random.Random(levels), 120, "abn")
    df = spark.createDataFrame(list(counts.items()), WORDS)
    near = st.near_words(df, words_block=5, queries_block=7, levels=levels).collect()
    pairs = Counter((r.word, r.near, r.near_n) for r in near)
    assert max(pairs.values()) == 1
    assert set(pairs) == {
        (w, e, counts[e]) for w in counts for e in edits(w, "abn") if e in counts and e != w
    }


def test_chains_ties_and_thresholds(spark):
    counts = {
        "alphabet": 1000, "alphabets": 100, "alphabetss": 10, "alphabetsss": 1,  # a chain
        "balloon": 5, "balloom": 50, "ballook": 50,  # a tie: the smaller goes
        "corridor": 5, "corridors": 49,  # one too few
        "distance": 7, "distancé": 7,
        "lonesome": 3,
    }
    got = groups(spark, counts)
    assert got == brute_groups(counts)
    assert got["alphabetsss"][1:3] == ("alphabetss", "alphabet")
    assert got["balloon"][1:] == ("ballook", "ballook", 2, 50)
    assert got["corridor"][1:] == (None, "corridor", 1, None)


def test_very_long_words(spark):
    rng = random.Random(3)
    base = "".join(rng.choice("abcdefgh") for _ in range(100_000))
    swapped = "b" if base[50_000] != "b" else "c"
    counts = {
        base: 100,
        base[:70_000] + base[70_001:]: 2,
        base[:50_000] + swapped + base[50_001:]: 3,
        base + "a": 1000,
        base[::-1]: 5,
        "a" * 48: 2, "a" * 49: 20, "a" * 300: 2, "a" * 301: 30,
    }
    got = groups(spark, counts)
    assert got[base][1] == base + "a" and got[base][3] == 3
    assert got["a" * 48][1] == "a" * 49 and got["a" * 300][1] == "a" * 301
    assert got[base[::-1]][3] == 0 and sum(v[3] for v in got.values()) == 2 * 5


def test_search_finds_what_the_budget_allows():
    rng = np.random.default_rng(5)
    vectors = rng.integers(0, 3, (200, 5))
    trie = st.CountTrie(vectors)
    for spent in (0, 1, 2):
        found = set()
        for query, row, _ in trie.search(vectors, np.full(len(vectors), spent)):
            new = set(zip(query.tolist(), row.tolist()))
            assert not new & found
            found |= new
        want = set()
        for q, a in enumerate(vectors):
            for r, b in enumerate(vectors):
                d = [x for x in b - a if x]
                allowed = {0: ([], [1], [1, -1]), 1: ([], [-1]), 2: ([],)}[spent]
                if d in [list(x) for x in allowed]:
                    want.add((q, r))
        assert found == want


def test_word_counts(spark):
    texts = [
        None, "", "short words only", "LETTERS letters Lettersß", "ÀÉÎÕÜàéîõü x", "abcdefgh1ijklmnop",
        "don't abcdefgh_ijklmnop", "日本語abcdefgh日本語", "word" * 50_000, (3, "letters repeated"),
        (None, "letters repeated"), (None, "letters repeated"),
    ]
    texts = [(k, t) if not isinstance(t, tuple) else t for k, t in enumerate(texts)]

    def brute(slip):
        counts = Counter()
        for doc, text in texts:
            for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
                run = lower(run)
                h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
                if slip and h % slip == 0:
                    run = run[: h % len(run)] + run[h % len(run) + 1 :]
                if len(run) >= 7:
                    counts[run] += 1
        return {w: n for w, n in counts.items() if n >= 2}

    extra = ["'a' as _id", "'b' as word", "1 as n"]
    df = docs_frame(spark, texts, extra)
    plain = {r.word: r.n for r in st.word_counts(df).collect()}
    assert plain == brute(0) and plain["letters"] == 5 and "àéîõüÀ" not in plain
    slipped = st.word_counts(df, slip=st.one_dropped(2))
    assert {r.word: r.n for r in slipped.collect()} == brute(2)


def test_empty_table(spark):
    counted = st.word_counts(spark.createDataFrame([], DOCS))
    assert counted.count() == 0 and st.spelling_groups(counted).count() == 0
    assert groups(spark, {"alonely": 2}) == {"alonely": (2, None, "alonely", 0, None)}
