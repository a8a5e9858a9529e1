import random

import public_tokenizers
import pytest
from helpers import DOCS, docs_frame
from tokenizers import Tokenizer

from marketlake.llm import token_counts
from marketlake.llm.token_counts import count_tokens, load_counter
from marketlake.session import shared_dir

PATH = public_tokenizers.path("byte_bpe_50k.json")


def library_counts(texts):
    encoded = Tokenizer.from_file(PATH).encode_batch([t or "" for t in texts], add_special_tokens=False)
    return [len(e.ids) for e in encoded]


def test_counts_by_parts_equal_the_library():
    rng = random.Random(1)
    letters = list("abzé日1!.,'") + [" "] * 4 + ["\n", "\t", "\xa0", "\x1c", " ", "  ", "\n\n", "<|endoftext|>",
                                     "'s", " the", "\r\n"]
    texts = ["".join(rng.choices(letters, k=rng.randrange(15))) for _ in range(20_000)]
    counter = load_counter(PATH)
    assert counter(texts) == library_counts(texts)


def test_emptying_the_memory_changes_nothing(monkeypatch):
    monkeypatch.setattr(token_counts.PartCounter, "MOST_PARTS", 3)
    counter = load_counter(PATH)
    texts = ["one two three four", "five six", "one two"]
    assert [counter([t])[0] for t in texts] == library_counts(texts)


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "piece_bpe_32k.model"])
def test_other_vocabularies(name):
    texts = ["Hello  world", "", "naïve\n日本"]
    path = public_tokenizers.path(name)
    if name.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        want = [len(model.encode(t)) for t in texts]
    else:
        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        want = [len(tokenizer.encode(t, add_special_tokens=False).ids) for t in texts]
    assert load_counter(path)(texts) == want


TEXTS = [None, "", "one two", "one two", "x" * 200_000, "word " * 50_000, "<|endoftext|> is special",
         " \n\t "]


def test_query_figures(spark):
    rows = list(enumerate(TEXTS)) + [(1, "again"), (None, "one two")]
    got = count_tokens(docs_frame(spark, rows), shared_dir(spark, "cache"), PATH).collect()
    want = sorted((str(i), len((t or "").encode()), n) for (i, t), n in
                  zip(rows, library_counts([t for _, t in rows])))
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens) for r in got) == want


def test_only_misses_are_encoded_and_appended(spark):
    cache = shared_dir(spark, "cache")
    count_tokens(docs_frame(spark, ["a b", "a b", "c"]), cache, PATH).collect()
    assert spark.read.parquet(cache).count() == 2
    # A stored count is taken as it is, which shows that nothing is encoded again.
    marked = spark.read.parquet(cache).selectExpr("content", "version", "n_tokens + 1000 as n_tokens")
    other = shared_dir(spark, "cache")
    marked.write.parquet(other)
    got = count_tokens(docs_frame(spark, ["a b", "c", "d e f"]), other, PATH).collect()
    assert {r.text: r.n_tokens > 1000 for r in got} == {"a b": True, "c": True, "d e f": False}
    assert spark.read.parquet(other).count() == 3
    # Counts of another tokenizer version do not mix in, and are kept beside.
    path = public_tokenizers.path("word_bpe_49k.json")
    got = count_tokens(docs_frame(spark, ["a b"]), other, path).first()
    assert got.n_tokens == 2 and spark.read.parquet(other).count() == 4


def test_empty_and_clashing(spark):
    cache = shared_dir(spark, "cache")
    assert count_tokens(spark.createDataFrame([], DOCS), cache, PATH).count() == 0
    df = docs_frame(spark, ["a"], ["'c' as content", "'v' as version", "'t' as _text", "5 as n_tokens"])
    row = count_tokens(df, cache, PATH).first()
    assert (row.content, row.version, row._text, row.n_tokens) == ("c", "v", "t", 1)
