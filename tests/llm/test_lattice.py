import collections
import math
import zlib

import numpy as np
import public_tokenizers
import pytest
from helpers import DOCS, docs_frame, lower, words
from pyspark.sql import functions as F

from marketlake.llm import lattice

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def vocab():
    return lattice.Vocabulary(PATH)


def all_segmentations(vocab, word, log_p):
    """Probability of a word and expected piece counts, by listing every segmentation."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=PATH)
    ids = [i for i in range(model.get_piece_size())
           if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    number = {model.id_to_piece(i): k for k, i in enumerate(ids)}
    text = lattice.MARK + word
    total, expected = 0.0, collections.Counter()
    stack = [(0, 0.0, ())]
    while stack:
        at, logp, used = stack.pop()
        if at == len(text):
            total += math.exp(logp)
            for u in used:
                expected[u] += math.exp(logp)
            continue
        for end in range(at + 1, len(text) + 1):
            if text[at:end] in number:
                k = number[text[at:end]]
                stack.append((end, logp + log_p[k], used + (k,)))
        by_bytes = tuple(vocab.n_pieces + b for b in text[at].encode())
        stack.append((at + 1, logp + sum(log_p[b] for b in by_bytes), used + by_bytes))
    return total, {k: v / total for k, v in expected.items()}


def test_marginals_and_expectations_cover_all_segmentations(vocab):
    log_p = np.log(vocab.given)
    batch = ["the", "hello", "naïve", "日本", "x", "ab"]
    lattices = lattice.Lattices(vocab, batch)
    got = lattices.marginals(log_p)
    counts = np.arange(1.0, len(batch) + 1)
    expected = np.zeros(vocab.size)
    for word, count, found in zip(batch, counts, got):
        total, pieces = all_segmentations(vocab, word, log_p)
        assert found == pytest.approx(math.log(total), abs=1e-9)
        for piece, share in pieces.items():
            expected[piece] += count * share
    assert np.allclose(lattices.expected(log_p, counts), expected, atol=1e-9)


def test_long_words_equal_short_recursion(vocab, monkeypatch):
    log_p = np.log(vocab.given)
    batch = ["a" * 70, "internationalisation" * 5, "b"]
    alone = lattice.Lattices(vocab, batch)
    monkeypatch.setattr(lattice, "LONG_WORD", 1000)
    together = lattice.Lattices(vocab, batch)
    assert np.allclose(alone.marginals(log_p), together.marginals(log_p))
    ones = np.ones(3)
    assert np.allclose(alone.expected(log_p, ones), together.expected(log_p, ones))


def test_a_distribution(vocab):
    """Piece weights and the end sum to 1."""
    assert vocab.given.sum() == pytest.approx(1)


TEXTS = ["The cat sat. the END", "the dog\tand the cat", None, "", "unseen words ünïcode 日本 here",
         "the the the", "x" * 300 + " the"]


def fold():
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(7)) != 2


def check_base(spark, rows, frequent):
    got = lattice.lattice_scores(docs_frame(spark, rows), fold(), PATH, frequent=frequent).collect()
    train = [words(lower(t)) for i, t in rows if i is not None and zlib.crc32(str(i).encode()) % 7 != 2]
    c = collections.Counter(w for t in train for w in t)
    ends = len(train)
    n, v = sum(c.values()) + ends, len(c) + (ends > 0)
    want = []
    for i, t in rows:
        tokens = words(lower(t))
        base = sum(math.log10((c[w] + 1) / (n + v + 1)) for w in tokens)
        base += math.log10((ends + 1) / (n + v + 1))
        known = sum(c[w] > 0 for w in tokens) + (ends > 0)
        want.append((str(i), len(tokens) + 1, known, n, round(base, 6)))
    assert sorted(want) == sorted(
        (str(r.doc_id), r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got)
    return got


@pytest.mark.parametrize("frequent", [2, 1000])
def test_base_equals_brute_force(spark, frequent):
    rows = list(enumerate(TEXTS * 3)) + [(5, "the the the"), (5, "other"), (None, "the dog"), (None, None)]
    got = check_base(spark, rows, frequent)
    by_text = collections.defaultdict(set)
    for (_, text), r in zip(sorted(rows, key=str), sorted(got, key=lambda r: str((r.doc_id, r.text)))):
        by_text[r.text or ""].add(round(r.score, 8))
        assert r.score < 0 and math.isfinite(r.score)
    assert all(len(s) == 1 for s in by_text.values())


def test_score_is_the_sum_of_the_words_marginals(spark, vocab):
    rows = list(enumerate(TEXTS[:2] + TEXTS[4:]))
    got = {r.doc_id: r.score for r in lattice.lattice_scores(docs_frame(spark, rows), fold(), PATH).collect()}
    train = [words(lower(t)) for i, t in rows if zlib.crc32(str(i).encode()) % 7 != 2]
    counts = collections.Counter(w for t in train for w in t)
    seen = list(counts)
    given = np.log(vocab.given)
    expected = lattice.Lattices(vocab, seen).expected(given, np.array([counts[w] for w in seen], float))
    total = expected.sum() + lattice.PRIOR + len(train) + 1
    log_p = np.log((expected + lattice.PRIOR * vocab.given) / total)
    end = math.log10((len(train) + 1) / total)
    for i, text in rows:
        tokens = words(lower(text))
        want = lattice.Lattices(vocab, tokens).marginals(log_p).sum() / math.log(10) + end
        assert got[i] == pytest.approx(want, abs=1e-6)


def test_learning_helps_held_out_text(spark, vocab):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    learned = lattice.lattice_scores(docs, fold(), PATH).filter(~fold()).agg(F.sum("score")).first()[0]
    given = lattice.lattice_scores(docs, F.lit(False), PATH).filter(~fold()).agg(F.sum("score")).first()[0]
    assert learned > given


def test_empty_and_clashing(spark):
    assert lattice.lattice_scores(spark.createDataFrame([], DOCS), fold(), PATH).count() == 0
    df = docs_frame(spark, ["a b"], ["'w' as word", "'t' as _train", "1 as score", "'i' as _id"])
    row = lattice.lattice_scores(df, fold(), PATH).first()
    assert (row.word, row._train, row._id) == ("w", "t", "i") and row.score < 0
