"""Small inputs and brute-force versions for the operators."""

import collections
import hashlib
import random
import re

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def item_words(text):
    return WORD.findall(lower(text))


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def docs_frame(spark, texts, extra=None):
    """Documents numbered from 0; `texts` may hold (id, text) pairs too."""
    rows = []
    for i, item in enumerate(texts):
        doc_id, text = item if isinstance(item, tuple) else (i, item)
        rows.append((doc_id, text, ["en", "de", None][i % 3], f"src{i % 4}", len(text or "")))
    df = spark.createDataFrame(rows, DOCS)
    return df if extra is None else df.selectExpr("*", *extra)


def random_words(rng, n, vocabulary=400):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def near_copies(seed=1):
    """Texts with exact copies, near copies on both sides of the threshold, and shared passages."""
    rng = random.Random(seed)
    passage = random_words(rng, 60)
    texts = [None, "", "   \n\t ", "one", "One", "two words", "Two  words", "a b c d e", "A b c d e"]
    for size in (3, 5, 6, 9, 12, 20, 40, 70, 130, 300, 700):
        base = random_words(rng, size)
        texts += [" ".join(base)] * 3 + ["  ".join(base).upper()]
        for changes in (1, 2, 3, 5, 8, 13, 30):
            copy = list(base)
            for _ in range(changes):
                at = rng.randrange(len(copy))
                copy[at] = f"x{rng.randrange(10**6)}"
            texts.append(" ".join(copy))
            texts.append(" ".join(copy[: len(copy) - changes]))
            texts.append(" ".join(base + random_words(rng, changes)))
    for n in (0, 5, 10, 20, 200):
        for _ in range(8):
            texts.append(" ".join(random_words(rng, n) + passage + random_words(rng, n)))
    return texts


def shingle_set(text, size=5):
    w = lower(text)
    w = words(w)
    if not w:
        return frozenset()
    return frozenset(tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1)))


def brute_components(rows, percent=80):
    """doc_id -> smallest linked doc_id, over (doc_id, text); rows of one id are one document."""
    parent = {i: i for i, _ in rows if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    sets = [(i, shingle_set(t)) for i, t in rows if i is not None]
    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            both = len(a & b)
            if i != j and both and 100 * both >= percent * (len(a) + len(b) - both):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in parent}


def brute_line_dedup(rows, min_chars=40, min_docs=5):
    """(doc_id, lines, dropped, kept text) of each (doc_id, text)."""
    def key(line):
        return lower(line.strip(" \t\n\x0b\f\r"))

    holders = collections.defaultdict(set)
    for i, text in rows:
        for line in (text or "").split("\n"):
            if i is not None:
                holders[key(line)].add(i)
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        keep = []
        for line in lines:
            k = key(line)
            repeated = len(k) >= min_chars and len(holders[k]) >= min_docs
            if not repeated or max(holders[k]) == i:
                keep.append(line)
        out.append((i, len(lines), len(lines) - len(keep), "\n".join(keep)))
    return out


def brute_hits(text, items, width=10):
    """(words, hit positions, item ids) of one text against (item_id, text) rows."""
    doc = item_words(text)
    hit, named = set(), set()
    for item, item_text in items:
        w = item_words(item_text)
        n = min(width, len(w))
        for s in range(len(w) - n + 1 if w else 0):
            for p in range(len(doc) - n + 1):
                if doc[p : p + n] == w[s : s + n]:
                    hit.update(range(p, p + n))
                    named.add(item)
    return len(doc), sorted(hit), sorted(str(x) for x in named if x is not None)
