"""Benchmark decontamination with a positional inverted index, in DataFrame operations only.

Postings (term, document, position) of all words that occur in any test item are stored once. A
test window is looked for from its rarest term: the occurrences of that term give possible starts,
which are intersected with the offset-adjusted occurrences of its second rarest term. What is left
is checked word by word, so the result is exact.

Scale: the index is written where the texts are read, without a shuffle, as long as Spark finds the
terms small enough to broadcast; the counts have map-side partials. Only postings of rarest and
second rarest terms are joined. Candidates are kept as one row per document, item and diagonal
(position minus offset), so a passage of many windows is one row. Texts are shuffled once at most,
for the check.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.llm.common import ascii_lower, pack, row_key, stored, text_or_empty, unpack

# A word is a run of digits, letters a-z after lower-casing, and characters beyond ASCII.
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def item_words(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(text), NOT_WORD), "")


class PositionalIndex:
    """Postings of the documents for the terms of some test items.

    `docs` and `items` are read by `id_col` and `item_col` and the text columns. Rows that share an
    id are told apart by their texts. `terms` (term, term_id, n), `postings` (term_id, _id, _th,
    pos) and `items` (_item, _key, words, terms) are stored tables; n counts a term's postings.
    """

    def __init__(
        self,
        docs: DataFrame,
        items: DataFrame,
        id_col: str = "doc_id",
        item_col: str = "item_id",
        text_col: str = "text",
    ):
        words = items.select(
            F.col(item_col).cast("string").alias("_item"),
            F.xxhash64(F.col(item_col), text_or_empty(text_col)).alias("_key"),
            item_words(text_or_empty(text_col)).alias("words"),
        ).dropDuplicates(["_item", "_key"])
        words = stored(words.filter(F.size("words") > 0))
        vocabulary = stored(
            words.select(F.explode("words").alias("term"))
            .distinct()
            .withColumn("term_id", F.monotonically_increasing_id())
        )
        tokens = docs.select(
            *row_key(id_col, text_col),
            F.posexplode(item_words(text_or_empty(text_col))).alias("pos", "term"),
        )
        self.postings = stored(
            tokens.join(vocabulary, "term").select("term_id", "_id", "_th", "pos")
        )
        counted = self.postings.groupBy("term_id").agg(F.count("*").alias("n"))
        self.terms = stored(
            vocabulary.join(counted, "term_id", "left").select(
                "term", "term_id", F.coalesce("n", F.lit(0)).alias("n")
            )
        )
        placed = (
            words.select("_key", F.posexplode("words").alias("off", "term"))
            .join(self.terms, "term")
            .groupBy("_key")
            .agg(F.array_sort(F.collect_list(F.struct("off", "term_id", "n"))).alias("terms"))
        )
        self.items = stored(
            words.join(placed, "_key").select("_item", "_key", "words", "terms")
        )

    def rarest_pairs(self, window: int) -> DataFrame:
        """The two rarest places of each window: _key, off_a, term_a, off_b, term_b.

        A window is `window` consecutive words of an item, or all of a shorter item. Windows with a
        term that no document has are left out. A window of one word has the same place twice.
        """
        width = F.least(F.size("terms"), F.lit(window))
        ranked = F.transform(
            F.sequence(F.lit(0), F.size("terms") - width),
            lambda s: F.array_sort(
                F.transform(
                    F.slice("terms", s + 1, width),
                    lambda t: F.struct(t["n"].alias("n"), t["off"].alias("off"), t["term_id"]),
                )
            ),
        )
        windows = self.items.select("_key", F.explode(ranked).alias("w"))
        second = F.coalesce(F.get("w", F.lit(1)), F.col("w")[0])
        return (
            windows.filter(F.col("w")[0]["n"] > 0)
            .select("_key", F.col("w")[0].alias("a"), second.alias("b"))
            .select(
                "_key",
                F.col("a.off").alias("off_a"),
                F.col("a.term_id").alias("term_a"),
                F.col("b.off").alias("off_b"),
                F.col("b.term_id").alias("term_b"),
            )
            .distinct()
        )

    def diagonals(self, window: int) -> DataFrame:
        """Where a window may occur: _id, _th, _key, diagonal (position of the item's first word).

        Occurrences of a window's rarest term, intersected with those of its second rarest term
        moved by the distance of the two in the item.
        """
        pairs = stored(self.rarest_pairs(window))
        starts = self.postings.join(pairs, F.col("term_id") == F.col("term_a")).select(
            "_id",
            "_th",
            "_key",
            (F.col("pos") - F.col("off_a")).alias("diagonal"),
            (F.col("pos") - F.col("off_a") + F.col("off_b")).alias("_pos"),
            F.col("term_b").alias("_term"),
        )
        seconds = self.postings.join(
            pairs.select("term_b").distinct(), F.col("term_id") == F.col("term_b"), "left_semi"
        ).select(
            F.col("_id").alias("_id2"), F.col("_th").alias("_th2"), "pos", "term_id"
        )
        met = starts.join(
            seconds,
            F.col("_id").eqNullSafe(F.col("_id2"))
            & (F.col("_th") == F.col("_th2"))
            & (F.col("_pos") == F.col("pos"))
            & (F.col("_term") == F.col("term_id")),
        )
        return met.select("_id", "_th", "_key", "diagonal").distinct()

    def proximity_matches(self, slop: int = 10) -> DataFrame:
        """Places where all terms of an item lie close together, in any order.

        Rows _id, _th, _item, pos: pos is an occurrence of the item's rarest term within reach of
        which (its number of words plus `slop`, to either side) every term of the item occurs.
        """
        distinct = self.items.select(
            "_item",
            "_key",
            (F.size("words") + slop).alias("_reach"),
            F.array_sort(
                F.array_distinct(
                    F.transform("terms", lambda t: F.struct(t["n"].alias("n"), t["term_id"]))
                )
            ).alias("_terms"),
        ).filter(F.col("_terms")[0]["n"] > 0)
        anchors = self.postings.join(
            distinct.withColumn("_anchor", F.col("_terms")[0]["term_id"]),
            F.col("term_id") == F.col("_anchor"),
        ).select("_id", "_th", "_item", "_key", "pos", "_reach", "_terms")
        needed = anchors.select(
            "_id", "_th", "_item", "_key", F.col("pos").alias("_at"), "_reach",
            F.size("_terms").alias("_needed"), F.explode("_terms.term_id").alias("_term"),
        )
        near = self.postings.select(
            F.col("_id").alias("_id2"), F.col("_th").alias("_th2"), "pos", "term_id"
        )
        found = needed.join(
            near,
            F.col("_id").eqNullSafe(F.col("_id2"))
            & (F.col("_th") == F.col("_th2"))
            & (F.col("_term") == F.col("term_id"))
            & (F.abs(F.col("pos") - F.col("_at")) <= F.col("_reach")),
        )
        return (
            found.groupBy("_id", "_th", "_item", "_key", "_at", "_needed")
            .agg(F.count_distinct("term_id").alias("_got"))
            .filter(F.col("_got") == F.col("_needed"))
            .select("_id", "_th", "_item", F.col("_at").alias("pos"))
        )


def phrase_hits(words: Column, found: Column, window: int) -> Column:
    """For each possible place, the positions of `words` inside occurrences of a whole window.

    `found` is an array of (item, words, diagonal); the result one of (item, hits).
    """

    def hits(place: Column) -> Column:
        phrase, diagonal = place["words"], place["diagonal"]
        width = F.least(F.size(phrase), F.lit(window))
        same = F.transform(
            phrase, lambda w, i: F.coalesce(F.get(words, diagonal + i) == w, F.lit(False))
        )

        # The one-element array binds the flags, so that they are computed once for a place.
        def covered(flags: Column) -> Column:
            starts = F.filter(
                F.sequence(F.lit(0), F.size(phrase) - width),
                lambda s: F.forall(F.slice(flags, s + 1, width), lambda x: x),
            )
            return F.flatten(
                F.transform(starts, lambda s: F.sequence(diagonal + s, diagonal + s + width - 1))
            )

        return F.struct(
            place["item"].alias("item"),
            F.array_distinct(F.transform(F.array(same), covered)[0]).alias("hits"),
        )

    return F.filter(F.transform(found, hits), lambda h: F.size(h["hits"]) > 0)


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    window: int = 10,
    id_col: str = "doc_id",
    item_col: str = "item_id",
    text_col: str = "text",
) -> DataFrame:
    """`docs` with `n_words`, `n_hit`, `n_items` (long), `hit_items` and `hit_words`.

    A window is `window` consecutive words of an item, or all words of a shorter item. A document
    word inside an occurrence of a window is hit. `hit_words` are the positions of the hit words,
    in order; `hit_items` the ids of the items whose windows occur, as strings in string order.

    Null or empty texts have no words, and an item without words has no window. Rows that share an
    id are each judged by their own text; equal rows give equal results. Items that share an id
    count once. An item without an id hits words, but is not among the items. Other columns pass
    through; a column named like a result is replaced. Empty tables: no rows, or no hits.
    """
    index = PositionalIndex(docs, items, id_col, item_col, text_col)
    places = (
        index.diagonals(window)
        .join(index.items.select("_key", "_item", "words"), "_key")
        .groupBy(F.col("_id").alias("_hit_id"), F.col("_th").alias("_hit_th"))
        .agg(
            F.collect_list(
                F.struct(F.col("_item").alias("item"), "words", "diagonal")
            ).alias("_places")
        )
    )
    rows = docs.select(
        pack(docs, text_col), *row_key(id_col, text_col), F.col(f"`{text_col}`").alias("_text")
    )
    joined = rows.join(
        places,
        F.col("_id").eqNullSafe(F.col("_hit_id")) & (F.col("_th") == F.col("_hit_th")),
        "left",
    )
    # The one-element array binds the words, so that they are made once for a document. They are
    # made above the join: a list of words is several times the size of the text in a shuffle.
    doc_words = item_words(F.coalesce(F.col("_text").cast("string"), F.lit("")))
    judged = F.transform(
        F.array(doc_words),
        lambda w: F.struct(
            F.size(w).alias("n"), phrase_hits(w, F.col("_places"), window).alias("found")
        ),
    )[0]
    checked = joined.select("_row", "_text", judged.alias("_judged"))
    found = F.coalesce(
        F.col("_judged.found"), F.array().cast("array<struct<item:string,hits:array<int>>>")
    )
    positions = F.array_sort(F.array_distinct(F.flatten(found["hits"])))
    named = F.array_sort(F.array_distinct(F.filter(found["item"], lambda x: x.isNotNull())))
    return unpack(
        checked,
        docs.columns,
        **{
            text_col: F.col("_text"),
            "n_words": F.col("_judged.n").cast("bigint"),
            "n_hit": F.size(positions).cast("bigint"),
            "n_items": F.size(named).cast("bigint"),
            "hit_items": named,
            "hit_words": positions,
        },
    )
