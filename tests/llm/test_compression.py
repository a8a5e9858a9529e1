import base64
import collections
import random
import re

import zstandard
from helpers import DOCS, docs_frame, random_words, words

from marketlake.llm.compression import Limits, compression_quality, repeated_words


def brute(text):
    text = text or ""
    w = words(text)
    windows = collections.Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    covered = {i + k for i in range(len(w) - 2) if windows[tuple(w[i : i + 3])] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered), failed)


def prose(seed, n):
    rng = random.Random(seed)
    syllables = "the of and ing er tion re on an st ble ea nd to in is es ly ou sh wh".split()
    return " ".join("".join(rng.choices(syllables, k=rng.randrange(1, 4))) for _ in range(n))


def test_base_figures_equal_brute_force(spark):
    rng = random.Random(1)
    texts = [None, "", " \n ", "a", "a b c a b c", "a b c d a b c", "é è #*$%&|<> ü", "x\nx\n\n x\nx "]
    texts += [" ".join(random_words(rng, n, v)) for n in (3, 10, 60, 300) for v in (2, 8, 500)]
    texts += ["\n".join(rng.choice(["one", "two three", "", " "]) for _ in range(30)) for _ in range(5)]
    rows = list(enumerate(texts)) + [(1, "dup id"), (None, "no id"), (3, "a")]
    got = compression_quality(docs_frame(spark, rows)).collect()
    figures = sorted(((str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines,
                       r.n_repeat_words, r.base_failed) for r in got), key=str)
    assert figures == sorted(((str(i), *brute(t)) for i, t in rows), key=str)


def test_verdicts(spark):
    noise = base64.b64encode(random.Random(2).randbytes(9000)).decode()
    noise = " ".join(noise[i : i + 9] for i in range(0, len(noise), 9))
    lines = "\n".join(f"{k} of the same line again and again with a number" for k in range(200))
    half = prose(3, 900) + "\n" + lines
    texts = {"prose": prose(1, 60), "long prose": prose(2, 5000), "noise": noise, "lines": lines,
             "half": half, "short": "a few words"}
    df = spark.createDataFrame(list(texts.items()), "name string, text string")
    got = {r.name: r for r in compression_quality(df).collect()}
    assert got["prose"].kept and got["long prose"].kept
    assert not got["noise"].kept and not got["noise"].base_failed and not got["noise"].ratio_ok
    assert not got["lines"].kept and not got["lines"].ratio_ok
    assert not got["half"].chunks_ok and not got["half"].kept
    assert got["short"].base_failed and not got["short"].kept
    data = texts["prose"].encode()
    ratio = len(zstandard.ZstdCompressor(level=3).compress(data)) / len(data)
    assert got["prose"].ratio == ratio and got["prose"].n_bytes == len(data)


def test_limits_by_length():
    limits = Limits(bands=((0, 0.0, 2.0), (100, 0.3, 0.9)))
    assert limits.within(99, 1.9) and not limits.within(100, 1.0) and limits.within(100, 0.3)


def test_very_long_and_many_distinct_words():
    rng = random.Random(4)
    w = [b"w%d" % rng.randrange(10**6) for _ in range(100_000)]
    assert repeated_words(w + w[:10]) == 20


def test_empty_and_clashing(spark):
    assert compression_quality(spark.createDataFrame([], DOCS)).count() == 0
    df = docs_frame(spark, ["a b"], ["'x' as _m", "'y' as _band", "'z' as kept"])
    row = compression_quality(df).first()
    assert (row._m, row._band, row.kept) == ("x", "y", False)
