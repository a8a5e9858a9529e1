"""Language-model scores from a subword lattice: all segmentations of a text count.

The vocabulary and its scores are given. A text is a sequence of pieces, drawn one after another,
then an end; its probability is the sum over all sequences of pieces that spell it. Pieces do not
cross words, so the sum factors into one lattice per word: a white-space mark and the word's
characters, with an arc for every piece and, for every character, one for its bytes. The forward
recursion in log space gives a word's marginal probability.

The given scores weigh the first pass over the training words: forward and backward recursions give
each piece's expected count there, and these counts, with the given scores as prior, are the
weights that score (one step of expectation maximisation).

Scale: texts are split once, into a stored table of each row's distinct words. Lattices run over the
distinct words of the corpus, each once, so what is gathered grows with the vocabulary of the input.
Counts have map-side partials; the words most frequent in the corpus (a fixed number) are broadcast,
the others joined by a shuffle, and each document's sums have map-side partials too. The piece weights are as many as the vocabulary file has pieces.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.llm.common import pack, row_key, stored, text_or_empty, tune_arrow, unpack

MARK = "▁"  # stands for the white space before a word
BASE = np.uint64(0x9E3779B97F4A7C15)
# Words broadcast with their figures; a fixed number of the most frequent ones.
FREQUENT = 1 << 16
FREQUENT_BYTES = 64
# Characters from which a word's recursion runs by itself and not next to others.
LONG_WORD = 64
# Pseudo-counts that the given scores are worth.
PRIOR = 1000.0


class Vocabulary:
    """Pieces of a sentencepiece file with a table of their prefixes, by hash."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = [
            i
            for i in range(model.get_piece_size())
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))
        ]
        pieces = [model.id_to_piece(i) for i in ids]
        scores = np.array([model.get_score(i) for i in ids])
        self.n_pieces = len(pieces)
        self.size = self.n_pieces + 256  # then the bytes
        if (scores == np.round(scores)).all():  # merge ranks: frequency falls as 1 / rank
            rank = np.empty(len(scores))
            rank[np.argsort(-scores, kind="stable")] = np.arange(len(scores))
            weight = 1 / (rank + 2.7)
        else:  # log probabilities
            weight = np.exp(scores)
        weight = np.r_[weight, np.full(256, weight.min())]
        self.given = weight / weight.sum()

        piece_of: dict[int, int] = {}
        for number, piece in enumerate(pieces):
            h = 0
            for at, char in enumerate(piece, 1):
                h = (h * int(BASE) + ord(char) + 1) & 0xFFFFFFFFFFFFFFFF
                if at == len(piece):
                    piece_of[h] = number
                else:
                    piece_of.setdefault(h, -1)
        self.hashes = np.array(sorted(piece_of), np.uint64)
        self.piece = np.array([piece_of[int(h)] for h in self.hashes], np.int64)
        self.longest = max(map(len, pieces))

    def arcs(self, text: np.ndarray, ends: np.ndarray):
        """Arrays (start, length, piece) of all pieces inside words.

        `text` are the code points of all words, `ends` for each place the end of its word.
        """
        starts, lengths, found = [], [], []
        at = np.arange(len(text))
        h = np.zeros(len(text), np.uint64)
        for length in range(1, self.longest + 1):
            inside = at + length <= ends[at]
            at, h = at[inside], h[inside]
            if not len(at):
                break
            h = h * BASE + text[at + length - 1] + np.uint64(1)
            where = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
            alive = self.hashes[where] == h
            at, h, where = at[alive], h[alive], where[alive]
            piece = self.piece[where]
            is_piece = piece >= 0
            starts.append(at[is_piece])
            lengths.append(np.full(len(starts[-1]), length))
            found.append(piece[is_piece])
        none = [np.empty(0, np.int64)]
        return tuple(np.concatenate(x or none) for x in (starts, lengths, found))


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


class Lattices:
    """The lattices of a batch of words under one set of log weights.

    Places are characters of all words one after another, and one place more for each word's end.
    Arcs are sorted so that all arcs of a group start and end at different places, and a group's
    starts are final when its turn comes.
    """

    def __init__(self, vocab: Vocabulary, batch: list[str]):
        marked = [MARK + w for w in batch]
        lengths = np.fromiter(map(len, marked), np.int64, len(marked))
        raw = np.frombuffer("".join(marked).encode("utf-32-le"), np.uint32)
        first = np.cumsum(lengths) - lengths
        ends = np.repeat(first + lengths, lengths)
        start, length, piece = vocab.arcs(raw.astype(np.uint64), ends)

        # One more arc for each character, through the pieces of its bytes.
        chars, which = np.unique(raw, return_inverse=True)
        self.char_bytes = [list(chr(c).encode("utf-8", "surrogatepass")) for c in chars]
        n = len(raw)
        start = np.r_[start, np.arange(n)]
        length = np.r_[length, np.full(n, 1)]
        label = np.r_[piece, vocab.size + which]  # labels above the pieces: character classes
        kind = np.r_[np.zeros(len(piece), np.int64), np.ones(n, np.int64)]

        word = np.repeat(np.arange(len(marked)), lengths)
        offset = np.arange(n) - first[word]
        self.vocab, self.n_words = vocab, len(marked)
        # A place of its own for each word's end.
        self.source = start + word[start]
        self.target = start + length + word[start]
        self.label = label
        self.begin = first + np.arange(len(marked))
        self.end = self.begin + lengths
        self.n_places = n + len(marked)

        long = lengths[word[start]] > LONG_WORD
        order = np.lexsort((kind, length, offset[start], long))
        self.source, self.target, self.label = (
            x[order] for x in (self.source, self.target, self.label)
        )
        n_short = int((~long).sum())
        group = ((offset[start] * (vocab.longest + 1) + length) * 2 + kind)[order][:n_short]
        cuts = np.flatnonzero(group[1:] != group[:-1]) + 1 if n_short else []
        self.groups = list(zip(np.r_[0, cuts].astype(int), np.r_[cuts, n_short].astype(int)))
        self.n_short = n_short

    def weights(self, log_p: np.ndarray) -> np.ndarray:
        """The log weight of each arc."""
        byte = log_p[self.vocab.n_pieces :]
        by_char = np.array([byte[b].sum() for b in self.char_bytes])
        return np.r_[log_p, by_char][self.label]

    def _spread(self, values, weight, source, target, backwards: bool) -> None:
        groups = reversed(self.groups) if backwards else self.groups
        for a, b in groups:
            if a < b:
                t = target[a:b]
                values[t] = np.logaddexp(values[t], values[source[a:b]] + weight[a:b])
        arcs = range(self.n_short, len(source))
        if backwards:
            # By falling start of the arc; offsets of one word fall with the order.
            arcs = reversed(arcs)
        for arc in arcs:
            t = target[arc]
            values[t] = np.logaddexp(values[t], values[source[arc]] + weight[arc])

    def forward(self, weight: np.ndarray) -> np.ndarray:
        """The log of the summed weight of all paths to each place."""
        values = np.full(self.n_places, -np.inf)
        values[self.begin] = 0.0
        self._spread(values, weight, self.source, self.target, False)
        return values

    def backward(self, weight: np.ndarray) -> np.ndarray:
        """The same for all paths from each place to its word's end."""
        values = np.full(self.n_places, -np.inf)
        values[self.end] = 0.0
        self._spread(values, weight, self.target, self.source, True)
        return values

    def marginals(self, log_p: np.ndarray) -> np.ndarray:
        """Natural log of each word's probability: the sum over all its segmentations."""
        return self.forward(self.weights(log_p))[self.end]

    def expected(self, log_p: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Expected count of each piece in the words, each taken `counts` times."""
        weight = self.weights(log_p)
        ahead, back = self.forward(weight), self.backward(weight)
        word = np.searchsorted(self.begin, self.source, side="right") - 1
        share = np.exp(ahead[self.source] + weight + back[self.target] - ahead[self.end][word])
        share *= counts[word]
        total = np.bincount(self.label, share, self.vocab.size + len(self.char_bytes))
        result = total[: self.vocab.size].copy()
        for count, used in zip(total[self.vocab.size :], self.char_bytes):
            for b in used:
                result[self.vocab.n_pieces + b] += count
        return result


def row_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """mapInArrow: _id, _th, _train, _text -> _id, _th, _train, word, times: a row's distinct words.

    Bytes are lower-cased and split: A-Z and ASCII white space alone.
    """
    for batch in batches:
        words, times, sizes = [], [], []
        for text in batch.column("_text").to_pylist():
            counted = Counter(text.encode().lower().split())
            words.extend(counted)
            times.extend(counted.values())
            sizes.append(len(counted))
        row = pa.array(np.repeat(np.arange(len(sizes)), sizes))
        yield pa.RecordBatch.from_arrays(
            [
                *[batch.column(c).take(row) for c in ("_id", "_th", "_train")],
                pa.array(words, pa.binary()).cast(pa.string()),
                pa.array(times, pa.int64()),
            ],
            names=["_id", "_th", "_train", "word", "times"],
        )


def expectation(path: str):
    """mapInArrow: word, train_count -> piece, expected; one row per piece and task."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path)
        log_p, total = np.log(vocab.given), np.zeros(vocab.size)
        for batch in batches:
            texts = batch.column("word").to_pylist()
            if texts:
                counts = batch.column("train_count").to_numpy().astype(float)
                total += Lattices(vocab, texts).expected(log_p, counts)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used.astype(np.int32)), pa.array(total[used])], names=["piece", "expected"]
        )

    return count


def scorer(path: str, log_p: np.ndarray):
    """mapInArrow: word, ... -> the same columns and log10p."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path)
        for batch in batches:
            texts = batch.column("word").to_pylist()
            found = Lattices(vocab, texts).marginals(log_p) if texts else np.empty(0)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(found / np.log(10))],
                names=[*batch.schema.names, "log10p"],
            )

    return score


def learn_weights(vocab: Vocabulary, expected: DataFrame, ends: int, prior: float):
    """(log weights of the pieces, log10 probability of the end) from expected piece counts.

    As many rows come to the driver as the vocabulary file has pieces.
    """
    summed = expected.groupBy("piece").agg(F.sum("expected").alias("expected")).toPandas()
    counts = np.zeros(vocab.size)
    counts[summed["piece"].to_numpy(int)] = summed["expected"].to_numpy()
    total = counts.sum() + prior + ends + 1
    return np.log((counts + prior * vocab.given) / total), float(np.log10((ends + 1) / total))


def lattice_scores(
    docs: DataFrame,
    train: Column,
    vocabulary_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    prior: float = PRIOR,
    frequent: int = FREQUENT,
) -> DataFrame:
    """`docs` with token counts and two scores of each text, learned where `train` holds.

    Tokens are words (runs other than ASCII white space, A-Z lower-cased), then one end.
    `n_tokens`; `n_known`, the tokens seen in training; `train_tokens`, how many tokens that was;
    `base_score`, the sum of log10((c + 1) / (N + V + 1)) over the tokens (c a token's training
    count, N all, V distinct ones); `score`, log10 of the text's lattice probability.

    Null texts count as empty: one token, the end. Rows that share an id are scored each by its own
    text, equal rows alike, and each training row counts. Where `train` is null the row is not
    trained on. Without training rows the given vocabulary scores alone are used. Other columns pass
    through; a column named like a result is replaced. Empty table: no rows.
    """
    tune_arrow(docs.sparkSession)
    trained = F.coalesce(train, F.lit(False)).alias("_train")
    keyed = docs.select(*row_key(id_col, text_col), trained, text_or_empty(text_col).alias("_text"))
    id_type = keyed.schema["_id"].dataType
    fields = [
        T.StructField("_id", id_type),
        T.StructField("_th", T.LongType()),
        T.StructField("_train", T.BooleanType()),
        T.StructField("word", T.StringType()),
        T.StructField("times", T.LongType()),
    ]
    # Texts are split once: all that follows reads these rows.
    tokens = stored(keyed.mapInArrow(row_words, T.StructType(fields)))
    counts = stored(
        tokens.groupBy("word").agg(
            F.sum("times").alias("total"),
            F.sum(F.when(F.col("_train"), F.col("times")).otherwise(0)).alias("train_count"),
        )
    )
    ends = docs.filter(train).count()
    seen = counts.filter(F.col("train_count") > 0)
    sums = seen.agg(F.sum("train_count").alias("n"), F.count("*").alias("v")).head()
    n_train = (sums["n"] or 0) + ends
    n_distinct = sums["v"] + (ends > 0)

    vocab = vocabulary(vocabulary_path)
    expected = seen.select("word", "train_count").mapInArrow(
        expectation(vocabulary_path), "piece int, expected double"
    )
    log_p, end_log10 = learn_weights(vocab, expected, ends, prior)
    fields = [*counts.schema.fields, T.StructField("log10p", T.DoubleType())]
    scored = stored(
        counts.mapInArrow(scorer(vocabulary_path, log_p), T.StructType(fields)).select(
            "word", "total", "train_count", "log10p"
        )
    )

    # At most `frequent` rows of words of `FREQUENT_BYTES`, whatever the input.
    brief = scored.filter(F.octet_length("word") <= FREQUENT_BYTES)
    top = stored(
        brief.orderBy(F.col("total").desc(), "word").limit(frequent).withColumn("_top", F.lit(1))
    )
    floor = np.log10(n_train + n_distinct + 1)
    times = F.col("times")
    figures = [
        F.sum("times").alias("_n"),
        F.sum(F.when(F.col("train_count") > 0, times).otherwise(0)).alias("_known"),
        F.sum(times * F.log10(F.col("train_count") + 1)).alias("_base"),
        F.sum(times * F.col("log10p")).alias("_score"),
    ]
    named = tokens.select("_id", "_th", "word", "times")
    by_top = named.join(F.broadcast(top), "word").groupBy("_id", "_th").agg(*figures)
    others = named.join(F.broadcast(top.select("word")), "word", "left_anti")
    by_others = others.join(scored, "word").groupBy("_id", "_th").agg(*figures)
    parts = by_top.union(by_others).groupBy("_id", "_th")
    summed = parts.agg(*[F.sum(c).alias(c) for c in ("_n", "_known", "_base", "_score")])
    # Rows with one id and one text were summed together.
    copies = docs.select(*row_key(id_col, text_col)).groupBy("_id", "_th").agg(
        F.count("*").alias("_copies")
    )
    per_row = (
        copies.withColumnsRenamed({"_id": "_cid", "_th": "_cth"})
        .join(summed, F.col("_cid").eqNullSafe(F.col("_id")) & (F.col("_cth") == F.col("_th")))
        .select("_cid", "_cth", "_copies", "_n", "_known", "_base", "_score")
    )
    rows = docs.select(pack(docs), *row_key(id_col, text_col))
    joined = rows.join(
        per_row, F.col("_id").eqNullSafe(F.col("_cid")) & (F.col("_th") == F.col("_cth")), "left"
    )

    def each(name: str) -> Column:
        return F.coalesce(F.col(name) / F.col("_copies"), F.lit(0.0))

    n_tokens = each("_n").cast("bigint") + 1
    end_base = float(np.log10(ends + 1))
    return unpack(
        joined,
        docs.columns,
        n_tokens=n_tokens,
        n_known=each("_known").cast("bigint") + int(ends > 0),
        train_tokens=F.lit(n_train).cast("bigint"),
        base_score=each("_base") + F.lit(end_base) - n_tokens * F.lit(float(floor)),
        score=each("_score") + F.lit(end_log10),
    )
