"""Quality rules from compression ratios: repetitive text compresses too well, random text not at all.

The Zstandard ratio (compressed bytes / bytes) is taken of the whole document and of each chunk of
fixed size. What a ratio should be depends on length, since a compressor has seen more of a long
text, so each length band has its own limits. A document is rejected if its whole ratio leaves its
band, or if too many of its bytes are in chunks that leave theirs: a long document may hide a bad half behind a good
average.

Scale: one pass, no shuffle; memory is bounded by an Arrow batch and the longest single text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm.common import pack, tune_arrow, unpack

SYMBOLS = re.compile(r"[#*$%&|<>]+")
RESULT = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "n_bytes long, ratio double, n_bad_bytes long"
)


@dataclass(frozen=True)
class Limits:
    """Bands as (bytes from, lowest ratio, highest ratio), in rising order of bytes.

    Prose of a few hundred bytes compresses to 0.5-0.7 of its size, of a few kilobytes to
    0.4-0.5, and long prose to about 0.35. The lowest ratios allow twice that redundancy; the
    highest ones are what encoded random bytes (0.75 and more) reach.
    """

    bands: tuple[tuple[int, float, float], ...] = (
        (0, 0.00, 2.00),  # a frame header outweighs such texts
        (128, 0.30, 0.95),
        (256, 0.28, 0.86),
        (1024, 0.24, 0.76),
        (4096, 0.20, 0.72),
        (16384, 0.16, 0.70),
    )
    chunk_bytes: int = 4096
    max_bad_share: float = 0.25
    level: int = 3
    _starts: tuple = field(init=False, repr=False, default=())

    def __post_init__(self):
        object.__setattr__(self, "_starts", tuple(b[0] for b in self.bands))

    def within(self, n_bytes: int, ratio: float) -> bool:
        _, low, high = self.bands[int(np.searchsorted(self._starts, n_bytes, side="right")) - 1]
        return low <= ratio <= high


def repeated_words(words: list[bytes], size: int = 3) -> int:
    """Words inside a window of `size` words that occurs twice or more, first one included."""
    n = len(words)
    if n <= size:
        return 0
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, n)
    if len(seen) < 2_000_000:  # three ids fit into 63 bits
        windows = np.zeros(n - size + 1, np.int64)
        for k in range(size):
            windows = windows * len(seen) + ids[k : n - size + 1 + k]
        _, inverse, counts = np.unique(windows, return_inverse=True, return_counts=True)
    else:
        rows = np.lib.stride_tricks.sliding_window_view(ids, size)
        _, inverse, counts = np.unique(rows, axis=0, return_inverse=True, return_counts=True)
    starts = np.flatnonzero(counts[inverse.ravel()] > 1)
    covered = np.zeros(n, bool)
    for k in range(size):
        covered[starts + k] = True
    return int(covered.sum())


def measure(text: str, limits: Limits, compressor) -> tuple:
    """All figures of one text, in the order of RESULT."""
    data = text.encode()
    words = data.split()  # on bytes: ASCII white space and nothing else
    symbols = sum(map(len, SYMBOLS.findall(text)))
    lines = [line for line in data.split(b"\n") if line.strip()]
    spaces = len(data) - sum(map(len, words))
    ratio = len(compressor.compress(data)) / len(data) if data else 0.0
    bad = 0
    for start in range(0, len(data), limits.chunk_bytes):
        chunk = data[start : start + limits.chunk_bytes]
        if not limits.within(len(chunk), len(compressor.compress(chunk)) / len(chunk)):
            bad += len(chunk)
    return (
        len(words),
        len(text) - spaces,
        symbols,
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(data),
        ratio,
        bad,
    )


def measurer(limits: Limits):
    @F.pandas_udf(RESULT)
    def figures(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        names = [part.split()[0] for part in RESULT.split(",")]
        compressor = zstandard.ZstdCompressor(level=limits.level)
        for texts in batches:
            yield pd.DataFrame(
                [measure(t or "", limits, compressor) for t in texts], columns=names
            )

    return figures


def compression_quality(
    docs: DataFrame, limits: Limits = Limits(), text_col: str = "text", min_words: int = 50
) -> DataFrame:
    """`docs` with word, symbol and repetition counts, compression figures and verdicts.

    `base_failed`: fewer than `min_words` words, or more than half of all words repeated.
    `ratio_ok`: the whole ratio lies within the band of its length. `chunks_ok`: at most
    `max_bad_share` of all bytes are in chunks that leave the band of their length. `kept`: not failed and both are ok.

    A duplicate line has a word and equals an earlier line exactly. Null text counts as empty:
    zeros, base_failed, not kept. Each row is judged by itself, so equal rows give equal results.
    Other columns pass through; a column named like a result is replaced. Empty table: no rows.
    """
    tune_arrow(docs.sparkSession)
    bands = F.lit(None).cast("array<double>")
    for start, low, high in limits.bands:
        bands = F.when(
            F.col("_m.n_bytes") >= start, F.array(F.lit(float(low)), F.lit(float(high)))
        ).otherwise(bands)
    measured = docs.select(
        pack(docs), measurer(limits)(F.col(f"`{text_col}`").cast("string")).alias("_m")
    ).withColumn("_band", bands)
    failed = (F.col("_m.n_words") < min_words) | (
        100 * F.col("_m.n_repeat_words") > 50 * F.col("_m.n_words")
    )
    ratio_ok = F.col("_m.ratio").between(F.col("_band")[0], F.col("_band")[1])
    chunks_ok = F.col("_m.n_bad_bytes") <= limits.max_bad_share * F.col("_m.n_bytes")
    names = [part.split()[0] for part in RESULT.split(",")]
    return unpack(
        measured,
        docs.columns,
        **{name: F.col("_m").getField(name) for name in names},
        base_failed=failed,
        ratio_ok=ratio_ok,
        chunks_ok=chunks_ok,
        kept=~failed & ratio_ok & chunks_ok,
    )
