"""Spelling variants by a frequency-vector trie.

Letters are dealt into groups, and a word is described by how many of its letters each group has.
The trie arranges words by these counts, one group a level. Words that differ by one inserted,
deleted or replaced code point have vectors that differ by one more in a group (surplus), one less
in a group (deficit), or both; so a depth-first search from a word's own counts, with a budget of one
surplus and one deficit, reaches the leaf of every near word. The words of a leaf are verified.

Each pair of leaves is reached from one side alone: a search spends its surplus first, and a deficit
only after it. Words of one leaf find each other.

Scale: the first levels of the trie are the key of a shuffle. A word goes to its own cell and, as a
query, to the cells that its budget allows on these levels; the rest of the trie is built and
searched inside a task, which streams the queries. There are more such levels the more words there
are. A cell with more words than one task should hold, or more queries, is cut into blocks of both,
each pair of which meets in a place of its own: nothing is dropped. What is searched is the
vocabulary, which counts with map-side partials have made of the texts.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm.common import stored, text_or_empty, tune_arrow

# Groups of letters: code points with one remainder.
GROUPS = 12
# Counts from here on are taken as this; differences do not grow by it.
MOST = 255
WIDE = MOST + 3
# Words, and queries, of a cell that meet in one task.
WORDS_BLOCK, QUERIES_BLOCK = 1 << 16, 1 << 19
# Words of a cell, on average, for which another level is added to the key.
CELL_WORDS = 1 << 15
# Steps of a search and pairs of a verification that are taken at once.
STEPS, PAIRS = 1 << 15, 1 << 18
# Code points up to which words are compared next to each other.
SHORT = 48
# Words that a task counts before it passes them on.
HELD = 200_000

Slip = Callable[[str, str], str]


def one_dropped(one_in: int) -> Slip:
    """A change of runs: of one in `one_in`, by CRC-32 of document and run, a code point goes."""

    def slip(doc: str, run: str) -> str:
        h = zlib.crc32(f"{doc}:{run}".encode())
        if h % one_in:
            return run
        at = h % len(run)
        return run[:at] + run[at + 1 :]

    return slip


def counter(min_chars: int, slip: Slip | None):
    """mapInArrow: _id, _text -> word, n; the runs of letters, counted over a task's documents."""
    runs = re.compile(f"[A-Za-zÀ-ÿ]{{{min_chars},}}")

    def batch_of(held: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())],
            names=["word", "n"],
        )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in batches:
            columns = (batch.column("_id").to_pylist(), batch.column("_text").to_pylist())
            for doc, text in zip(*columns):
                for run, n in Counter(runs.findall(text)).items():
                    word = run.encode("latin-1").lower().decode("latin-1")  # A-Z alone
                    if slip is not None:
                        word = slip(doc, word)
                    if len(word) >= min_chars:
                        held[word] += n
            if len(held) >= HELD:
                yield batch_of(held)
                held = Counter()
        yield batch_of(held)

    return count


def word_counts(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = 7,
    min_count: int = 2,
    slip: Slip | None = None,
) -> DataFrame:
    """word, n: maximal runs of [A-Za-zÀ-ÿ] with A-Z lower-cased, at least `min_chars` code
    points long and found at least `min_count` times.

    `slip` may change a run, given its document's id as text (null: empty) and the run. Null texts
    have no words; repeated rows count again. Other columns are not read. Empty table: no rows.
    """
    tune_arrow(docs.sparkSession)
    name = F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).alias("_id")
    rows = docs.select(name, text_or_empty(f"`{text_col}`").alias("_text"))
    counted = rows.mapInArrow(counter(min_chars, slip), "word string, n long")
    summed = counted.groupBy("word").agg(F.sum("n").alias("n"))
    return summed.filter(F.col("n") >= min_count)


def letters(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(code points of all words one after another, lengths)."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    return np.frombuffer("".join(words).encode("utf-32-le"), np.uint32), lengths


def count_vectors(words: list[str]) -> np.ndarray:
    """One row a word: how many of its code points each group has, `MOST` at most."""
    points, lengths = letters(words)
    at = np.repeat(np.arange(len(words)), lengths) * GROUPS + points % GROUPS
    counts = np.bincount(at, minlength=len(words) * GROUPS).reshape(len(words), GROUPS)
    return np.minimum(counts, MOST).astype(np.int64)


def moves(levels: int) -> np.ndarray:
    """All changes of `levels` counts that a search may make: none, a surplus, then a deficit."""
    found = [np.zeros(levels, np.int64)]
    for i in range(levels):
        up = np.zeros(levels, np.int64)
        up[i] = 1
        found.append(up)
        for j in range(i + 1, levels):
            found.append(up - np.eye(levels, dtype=np.int64)[j])
    return np.array(found)


def router(levels: int):
    """mapInArrow: word, n -> cell, is_query, word, n; a word once as itself, and to each cell that
    its budget allows as a query."""
    changes = moves(levels)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            own = count_vectors(batch.column("word").to_pylist())[:, :levels]
            everything = np.arange(len(own))
            for number, change in enumerate([changes[0], *changes]):
                to = own + change
                rows = everything[((to >= 0) & (to <= MOST)).all(axis=1)]
                keys = np.ascontiguousarray(to[rows].astype(np.uint8))
                cell = pa.Array.from_buffers(
                    pa.binary(levels), len(rows), [None, pa.py_buffer(keys.tobytes())]
                ).cast(pa.binary())
                taken = batch.take(pa.array(rows))
                yield pa.RecordBatch.from_arrays(
                    [cell, pa.array(np.full(len(rows), number > 0)), *taken.columns],
                    names=["cell", "is_query", "word", "n"],
                )

    return route


class CountTrie:
    """Count vectors as a trie: for each level the sorted codes (parent node, count) of its nodes."""

    def __init__(self, counts: np.ndarray):
        self.order = np.lexsort(counts.T[::-1]) if counts.shape[1] else np.arange(len(counts))
        counts = counts[self.order]
        node, fresh = np.zeros(len(counts), np.int64), np.arange(len(counts)) == 0
        self.levels = []
        for level in range(counts.shape[1]):
            code = node * WIDE + counts[:, level]
            fresh = np.r_[True, code[1:] != code[:-1]]
            self.levels.append(code[fresh])
            node = np.cumsum(fresh) - 1
        self.first = np.flatnonzero(fresh)
        self.last = np.r_[self.first[1:], len(counts)]

    def search(self, counts: np.ndarray, spent: np.ndarray):
        """Arrays (query, row, spent) of all rows whose leaves the queries reach, part by part.

        `spent`: 0 nothing, 1 the surplus, 2 the deficit too. Depth first, many queries at a time.
        """
        starts = range(0, len(counts), STEPS)
        stack = [
            (0, np.arange(a, min(a + STEPS, len(counts))), None, spent[a : a + STEPS])
            for a in starts
        ]
        while stack:
            level, query, node, state = stack.pop()
            if node is None:
                node = np.zeros(len(query), np.int64)
            if level == len(self.levels):
                yield from self._rows(query, node, state)
                continue
            wanted = counts[query, level]
            up, down = state == 0, state == 1
            query = np.r_[query, query[up], query[down]]
            code = np.r_[node, node[up], node[down]] * WIDE
            code += np.r_[wanted, wanted[up] + 1, np.maximum(wanted[down] - 1, -1)]
            alive = np.r_[np.full(len(wanted), True), wanted[up] < MOST, wanted[down] > 0]
            state = np.r_[state, state[up] + 1, state[down] + 1]
            child = np.minimum(np.searchsorted(self.levels[level], code), len(self.levels[level]) - 1)
            alive &= self.levels[level][child] == code
            query, child, state = query[alive], child[alive], state[alive]
            for a in range(0, len(query), STEPS):
                part = slice(a, a + STEPS)
                stack.append((level + 1, query[part], child[part], state[part]))

    def _rows(self, query, leaf, state):
        sizes = self.last[leaf] - self.first[leaf]
        done = np.cumsum(sizes)
        cuts = np.searchsorted(done, np.arange(PAIRS, done[-1] if len(done) else 0, PAIRS))
        for a, b in zip(np.r_[0, cuts], np.r_[cuts, len(query)]):
            size = sizes[a:b]
            if size.sum():
                offset = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
                row = self.order[np.repeat(self.first[leaf[a:b]], size) + offset]
                yield np.repeat(query[a:b], size), row, np.repeat(state[a:b], size)


class Spelled:
    """Words as rows of code points, for comparing many pairs at once."""

    def __init__(self, words: list[str]):
        self.words = words
        points, self.lengths = letters(words)
        width = int(min(SHORT, self.lengths.max(initial=0))) + 1
        self.points = np.zeros((len(words), width), np.uint8)
        row = np.repeat(np.arange(len(words)), self.lengths)
        column = np.arange(len(points)) - np.repeat(
            np.cumsum(self.lengths) - self.lengths, self.lengths
        )
        inside = column < width
        self.points[row[inside], column[inside]] = points[inside]


def one_apart(a: str, b: str) -> bool:
    """The words differ by one inserted, deleted or replaced code point."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    low, high = 0, len(a)  # the longest common beginning
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if a[:middle] == b[:middle] else (low, middle - 1)
    return a[low + (len(a) == len(b)) :] == b[low + 1 :]


def verified(left: Spelled, i: np.ndarray, right: Spelled, j: np.ndarray) -> np.ndarray:
    """Which of the pairs (left word i, right word j) are one apart."""
    n_left, n_right = left.lengths[i], right.lengths[j]
    near = np.zeros(len(i), bool)
    short = np.maximum(n_left, n_right) <= SHORT
    for turned in (False, True):
        take = np.flatnonzero(short & ((n_left > n_right) == turned))
        less, x, more, y = (right, j, left, i) if turned else (left, i, right, j)
        a, b = less.points[x[take]], more.points[y[take]]
        width = min(a.shape[1], b.shape[1])
        a, b_next = a[:, :width], b[:, 1 : width + 1]
        b = b[:, :width]
        size, longer = less.lengths[x[take]], more.lengths[y[take]]
        differs = a != b
        same = size == longer
        # A shorter word: after the first difference, all is shifted by one.
        place = np.arange(b_next.shape[1])
        first = np.where(differs.any(axis=1), differs.argmax(axis=1), width)
        shifted = a[:, : b_next.shape[1]] != b_next
        shifted &= (place >= first[:, None]) & (place < size[:, None])
        inserted = (longer == size + 1) & ~shifted.any(axis=1)
        near[take] = np.where(same, differs.sum(axis=1) == 1, inserted)
    for k in np.flatnonzero(~short):
        near[k] = one_apart(left.words[i[k]], right.words[j[k]])
    return near


class Cell:
    """The words of one place, and the queries that have come for them so far."""

    def __init__(self, cell: bytes):
        self.prefix = np.frombuffer(cell, np.uint8).astype(np.int64)
        self.words: list[str] = []
        self.n: list[int] = []
        self.queries: list[str] = []
        self.query_n: list[int] = []
        self.trie: CountTrie | None = None

    def found(self) -> Iterator[pa.RecordBatch]:
        """word, n, near, near_n for the queries so far, which are then let go."""
        queries, query_n = self.queries, np.array(self.query_n, np.int64)
        self.queries, self.query_n = [], []
        if not self.words or not queries:
            return
        levels = len(self.prefix)
        if self.trie is None:
            self.trie = CountTrie(count_vectors(self.words)[:, levels:])
            self.spelled, self.counts = Spelled(self.words), np.array(self.n, np.int64)
        vectors, asked = count_vectors(queries), Spelled(queries)
        spent = np.abs(self.prefix - vectors[:, :levels]).sum(axis=1)
        for query, row, state in self.trie.search(vectors[:, levels:], spent):
            near = verified(asked, query, self.spelled, row)
            query, row, state = query[near], row[near], state[near]
            # Other leaves do not search back; words of one leaf do.
            back = np.flatnonzero(state)
            ours = pa.array(queries, pa.string()).take(pa.array(query))
            theirs = pa.array(self.words, pa.string()).take(pa.array(row))
            n_ours, n_theirs = query_n[query], self.counts[row]
            turned = pa.array(back)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.concat_arrays([ours, theirs.take(turned)]),
                    pa.concat_arrays([theirs, ours.take(turned)]),
                    pa.array(np.r_[n_theirs, n_ours[back]]),
                ],
                names=["word", "near", "near_n"],
            )


def search_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """mapInArrow: place, cell, is_query, word, n in this order -> word, near, near_n."""
    here, place = None, None
    for batch in batches:
        rows = zip(*(batch.column(c).to_pylist() for c in ("cell", "place", "is_query", "word", "n")))
        for cell, at, is_query, word, n in rows:
            if (cell, at) != place:
                if here is not None:
                    yield from here.found()
                here, place = Cell(cell), (cell, at)
            if is_query:
                here.queries.append(word)
                here.query_n.append(n)
                if len(here.queries) >= STEPS:
                    yield from here.found()
            else:
                here.words.append(word)
                here.n.append(n)
    if here is not None:
        yield from here.found()


def key_levels(n_words: int) -> int:
    """Levels of the trie in the key of the shuffle: a level parts a cell in about 2.6."""
    return min(GROUPS, max(4, math.ceil(math.log(max(n_words, 1) / CELL_WORDS) / math.log(2.6))))


def near_words(
    words: DataFrame,
    words_block: int = WORDS_BLOCK,
    queries_block: int = QUERIES_BLOCK,
    levels: int | None = None,
) -> DataFrame:
    """word, near, near_n: all ordered pairs of the words (word, n) that are one edit apart, once.

    `words` has each word once, of code points up to U+00FF. The blocks and `levels` change where
    the work is done, not the result.
    """
    if levels is None:
        levels = key_levels(words.count())
    routed = words.select("word", "n").mapInArrow(
        router(levels), "cell binary, is_query boolean, word string, n long"
    )

    def blocks(of: str, size: int):
        return F.greatest(F.ceil(F.col(of) / size), F.lit(1)).cast("int")

    sizes = routed.groupBy("cell").agg(
        F.count_if(~F.col("is_query")).alias("_words"), F.count_if("is_query").alias("_queries")
    )
    large = stored(
        sizes.select(
            "cell",
            blocks("_words", words_block).alias("_by_word"),
            blocks("_queries", queries_block).alias("_by_query"),
        ).filter("_by_word * _by_query > 1")
    )
    if large.isEmpty():
        dealt = routed.withColumn("place", F.lit(0))
    else:
        # At most one row for each block; the others have one place.
        met = routed.join(large, "cell", "left")
        many_w = F.coalesce("_by_word", F.lit(1))
        many_q = F.coalesce("_by_query", F.lit(1))
        own = F.pmod(F.xxhash64("word"), F.when(F.col("is_query"), many_q).otherwise(many_w))
        others = F.sequence(F.lit(0), F.when(F.col("is_query"), many_w).otherwise(many_q) - 1)
        spread = met.select("cell", "is_query", "word", "n", many_q.alias("_q"), own.alias("_own"),
                            F.explode(others).alias("_other"))
        at = F.when(F.col("is_query"), F.col("_other") * F.col("_q") + F.col("_own")).otherwise(
            F.col("_own") * F.col("_q") + F.col("_other")
        )
        dealt = spread.select("cell", "is_query", "word", "n", at.cast("int").alias("place"))
    return (
        dealt.repartition("cell", "place")
        .sortWithinPartitions("cell", "place", "is_query")
        .select("cell", "place", "is_query", "word", "n")
        .mapInArrow(search_cells, "word string, near string, near_n long")
    )


def spelling_groups(words: DataFrame, times: int = 10, **blocks: int) -> DataFrame:
    """word, n, form, root, n_near, form_n of each of the words (word, n).

    `form` is the near word of largest n (ties: the smallest in code-point order) if its n is at
    least `times` that of the word, else null, and `form_n` its n. `root` is reached from a word by
    following forms to the last, the word itself if it has none. `n_near`: its near words.
    """
    if times < 2:
        raise ValueError("times must be 2 at least: forms must have more occurrences")
    words = stored(words.select("word", F.col("n").cast("bigint").alias("n")))
    best = F.min(F.struct((-F.col("near_n")).alias("_less"), F.col("near").alias("form")))
    near = near_words(words, **blocks).groupBy("word").agg(
        F.count("*").alias("n_near"), best.alias("_best")
    )
    form_n = -F.col("_best._less")
    found = words.join(near, "word", "left").withColumn("_is", form_n >= F.col("n") * times)
    formed = stored(
        found.select(
            "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(F.col("_is"), F.col("_best.form")).alias("form"),
            F.when(F.col("_is"), form_n).alias("form_n"),
        )
    )
    # Occurrences grow by `times` with each step, so a chain is short; each round doubles a step.
    most = formed.agg(F.max("n").alias("n")).head()["n"] or 1
    steps = math.ceil(math.log(most, times)) + 1
    roots = formed.filter("form is not null").select("word", F.col("form").alias("root"))
    for _ in range(math.ceil(math.log2(steps)) if steps > 1 else 0):
        onward = roots.select(F.col("word").alias("root"), F.col("root").alias("_on"))
        roots = stored(
            roots.join(onward, "root", "left").select("word", F.coalesce("_on", "root").alias("root"))
        )
    return formed.join(roots, "word", "left").select(
        "word", "n", "form", F.coalesce("root", "word").alias("root"), "n_near", "form_n"
    )
