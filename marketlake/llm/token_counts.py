"""Token counts through a cache keyed by content and tokenizer digests.

A text is encoded once: its SHA-256 and the digest of the tokenizer file are looked up in a
stored table of counts, distinct misses are encoded and appended, and the counts are joined back.

Scale: the lookup moves digests, not texts. Misses are reduced to one text per digest with
map-side partials, so a text copied a million times crosses the network once per map task. The
cache is a Parquet folder shared by all executors; an append is committed as a whole or not at
all, and after a failure the next run encodes what is still missing.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from itertools import chain

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.llm.common import (
    heavy_lookup,
    pack,
    stored,
    text_or_empty,
    tune_arrow,
    unpack,
)

CACHE_SCHEMA = T.StructType(
    [
        T.StructField("content", T.BinaryType()),
        T.StructField("version", T.StringType()),
        T.StructField("n_tokens", T.LongType()),
    ]
)
# Texts handed to the tokenizer at once, in characters; bounds the memory of its results.
ENCODE_CHARS = 1 << 20


def tokenizer_version(path: str) -> str:
    """Digest of a vocabulary file: counts of another file are never mixed in."""
    with open(path, "rb") as file:
        return hashlib.sha256(file.read()).hexdigest()


def cuts_at_spaces(path: str) -> bool:
    """Whether a vocabulary splits texts by the byte-level pattern alone, before anything else.

    That pattern always ends a piece before a run of white space, so a text's tokens are those of
    its parts between such places (see `PartCounter`).
    """
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    split = spec.get("pre_tokenizer") or {}
    return (
        spec.get("normalizer") is None
        and split.get("type") == "ByteLevel"
        and split.get("use_regex", True)
        and not split.get("add_prefix_space", True)
        and not spec["model"].get("dropout")
    )


class PartCounter:
    """Token counts by parts of a text, each distinct part encoded once by the library.

    A part is a run of spaces and line feeds with the characters up to the next run. A text that
    holds other white space, or the string of an added token, is encoded whole.
    """

    PARTS = re.compile(r"[ \n]*[^ \n]+|[ \n]+")
    OTHER_SPACE = re.compile(r"[^\S \n]")
    MOST_PARTS = 1 << 19  # the memory is emptied beyond, which changes no count

    def __init__(self, tokenizer, encode):
        self.encode = encode
        self.known: dict[str, int] = {}
        self.added = [t.content for t in tokenizer.get_added_tokens_decoder().values()]

    def __call__(self, texts: list[str]) -> list[int]:
        whole = [
            bool(self.OTHER_SPACE.search(t)) or any(a in t for a in self.added) for t in texts
        ]
        parts = [[] if w else self.PARTS.findall(t) for t, w in zip(texts, whole)]
        if len(self.known) > self.MOST_PARTS:
            self.known.clear()
        new = list(set(chain.from_iterable(parts)).difference(self.known))
        self.known.update(zip(new, self.encode(new)))
        by_whole = iter(self.encode([t for t, w in zip(texts, whole) if w]))
        find = self.known.__getitem__
        return [next(by_whole) if w else sum(map(find, p)) for p, w in zip(parts, whole)]


def load_counter(path: str):
    """A function from a list of texts to their token counts, without added tokens."""
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(ids) for ids in model.encode(texts, num_threads=1)]
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()

    def encode(texts: list[str]) -> list[int]:
        return [len(e) for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    return PartCounter(tokenizer, encode) if cuts_at_spaces(path) else encode


def text_counter(path: str):
    """Pandas UDF: the token count of each text."""

    @F.pandas_udf("long")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = load_counter(path)
        for texts in batches:
            counts, group, chars = [], [], 0
            for text in texts:
                group.append(text)
                chars += len(text)
                if chars >= ENCODE_CHARS:
                    counts += counter(group)
                    group, chars = [], 0
            counts += counter(group) if group else []
            yield pd.Series(counts, dtype="int64")

    return count


def read_cache(spark: SparkSession, cache: str, version: str) -> DataFrame:
    """Counts stored for one tokenizer version, one row per content digest."""
    rows = spark.read.schema(CACHE_SCHEMA).parquet(cache).filter(F.col("version") == version)
    return rows.groupBy("content").agg(F.max("n_tokens").alias("_n_tokens"))


def count_tokens(
    docs: DataFrame,
    cache: str,
    tokenizer_path: str,
    text_col: str = "text",
) -> DataFrame:
    """`docs` with `n_bytes` (UTF-8) and `n_tokens`, both long; fills the cache on the way.

    `cache` is a folder all executors share; it is made on first use. Null text counts as empty:
    0 bytes, 0 tokens. Nothing but null is normalised, because any other change could change a
    count. Equal texts are encoded once. Two runs that append the same text at a time leave equal
    rows, of which one is read. Other columns pass through; a column named like a result is
    replaced. Empty table: no rows.
    """
    spark = docs.sparkSession
    tune_arrow(spark)
    version = tokenizer_version(tokenizer_path)
    spark.createDataFrame([], CACHE_SCHEMA).write.mode("append").parquet(cache)
    keyed = docs.select(
        pack(docs),
        text_or_empty(text_col).alias("_text"),
    ).withColumn("_content", F.unhex(F.sha2("_text", 256)))

    contents = keyed.groupBy("_content").agg(F.first("_text").alias("_text"))
    known = read_cache(spark, cache, version)
    misses = contents.join(known, contents["_content"] == known["content"], "left_anti")
    misses.select(
        F.col("_content").alias("content"),
        F.lit(version).alias("version"),
        text_counter(tokenizer_path)("_text").alias("n_tokens"),
    ).write.mode("append").parquet(cache)

    # How often each text occurs, so that the counts of the most frequent ones can be broadcast.
    often = keyed.groupBy("_content").agg(F.count("*").alias("_rows"))
    counted = read_cache(spark, cache, version)
    counts = stored(
        often.join(counted, often["_content"] == counted["content"]).select(
            "_content", "_rows", "_n_tokens"
        )
    )
    sized = keyed.withColumn("_n_bytes", F.octet_length("_text").cast("bigint")).drop("_text")
    joined = heavy_lookup(sized, counts, ["_content"], "_rows", ["_n_tokens"])
    return unpack(
        joined, docs.columns, n_bytes=F.col("_n_bytes"), n_tokens=F.col("_n_tokens")
    )
