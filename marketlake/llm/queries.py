"""The thin queries over the given tables, one for each operator, with their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.llm import (
    compression,
    lattice,
    line_dedup,
    multi_index,
    parity_join,
    positional_index,
    prefix_trie,
    quotes,
    raking,
    ranking,
    spelling_trie,
    text_density,
    token_counts,
)
from marketlake.llm.common import shared_dir, stored

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(id_col: str, folds: int):
    """CRC-32 of the id as text, modulo `folds`."""
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(folds))


def query(name: str, oracle: str | None = None):
    def wrap(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return wrap


@query("op1_parity_join")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return parity_join.jaccard_classes(docs)


@query("op2_compression_bands")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return compression.compression_quality(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "ratio", "n_bytes", "n_bad_bytes",
    )


@query("op3_quotation_linking")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes.link_conversations(table(spark, sf_dir, "conversations"))


@query("op4_text_density")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return text_density.extract_main_text(pages).select("page_id", "url", "text", "n_chars")


VOCABULARY = "piece_bpe_32k.model"


@query("op5_subword_lattice")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = lattice.lattice_scores(
        docs, fold("doc_id", 7) != 2, public_tokenizers.path(VOCABULARY)
    )
    return scored.select(
        "doc_id", (fold("doc_id", 7) == 2).alias("held_out"),
        "n_tokens", "n_known", "train_tokens", "base_score", "score",
    )


@query(
    "op6_positional_index",
    r"""
    with doc_words as (
        select doc_id, regexp_extract_all(translate(coalesce(text, ''),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
        from documents
    ), item_words as (
        select item_id, regexp_extract_all(translate(coalesce(text, ''),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
        from benchmark
    ), item_windows as (
        select distinct item_id, width, array_to_string(w[s : s + width - 1], ' ') as phrase
        from (
            select item_id, w, least(len(w), 10) as width,
                unnest(range(1, len(w) - least(len(w), 10) + 2)) as s
            from item_words where len(w) > 0
        )
    ), doc_windows as (
        select doc_id, s, width, array_to_string(w[s : s + width - 1], ' ') as phrase
        from (
            select doc_id, w, width, unnest(range(1, len(w) - width + 2)) as s
            from doc_words, (select distinct width from item_windows) where len(w) >= width
        )
    ), found as (
        select doc_id, s, width, item_id from doc_windows join item_windows using (width, phrase)
    ), hit as (
        select doc_id, count(distinct p) as n_hit
        from (select doc_id, unnest(range(s, s + width)) as p from found) group by doc_id
    ), named as (
        select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as items
        from (select distinct doc_id, cast(item_id as varchar) as item from found) group by doc_id
    )
    select doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit,
        coalesce(n_items, 0) as n_items, sha256(coalesce(items, '')) as items_sha256,
        coalesce(n_hit, 0) > 0 as contaminated
    from doc_words left join hit using (doc_id) left join named using (doc_id)
    """,
)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    judged = positional_index.decontaminate(docs, table(spark, sf_dir, "benchmark"))
    return judged.select(
        "doc_id", "n_words", "n_hit", "n_items",
        F.sha2(F.array_join("hit_items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@query("op7_raking")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    return raking.mix_sources(docs).drop("text")


@query("op8_pairwise_ranking")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels")
    ranked = ranking.rank_quality(docs, labels, train=fold("doc_id", 5) != 0)
    return ranked.select(
        "doc_id",
        (fold("doc_id", 5) == 0).alias("held_out"),
        "score",
        F.col("kept").cast("int").alias("predicted"),
    )


TOKENIZER = "byte_bpe_50k.json"
TOKEN_LIMIT = 512


@query("op9_token_counts")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = token_counts.count_tokens(
        docs, shared_dir(spark, "token-counts"), public_tokenizers.path(TOKENIZER)
    )
    return counted.select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit")
    )


@query(
    "op10_line_dedup",
    """
    with lines as (
        select doc_id, parts, unnest(range(len(parts))) as pos, unnest(parts) as line
        from (select doc_id, string_split(coalesce(text, ''), chr(10)) as parts from documents)
    ), keyed as (
        select doc_id, pos, line,
            translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as line_key
        from lines
    ), repeated as (
        select line_key, max(doc_id) as keeper from keyed
        where length(line_key) >= 40 group by line_key having count(distinct doc_id) >= 5
    )
    select doc_id, count(*) as n_lines,
        count(*) filter (where keeper is not null and doc_id <> keeper) as n_dropped,
        sha256(coalesce(string_agg(line, chr(10) order by pos)
            filter (where keeper is null or doc_id = keeper), '')) as kept_sha256
    from keyed left join repeated using (line_key) group by doc_id
    """,
)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs).select(
        "doc_id",
        "n_lines",
        "n_dropped",
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"),
    )


def crc32_sql(text: str) -> str:
    """CRC-32 of the UTF-8 bytes of an SQL text expression."""
    hexed = f"hex(encode({text}))"
    octets = (
        f"list_transform(range(0, length({hexed}), 2), lambda i: "
        f"cast('0x' || substr({hexed}, cast(i as integer) + 1, 2) as ubigint))"
    )
    shifted = (
        "list_reduce(list_prepend(xor(c, b), cast(range(8) as ubigint[])), "
        "lambda k, i: xor(k >> 1, cast(3988292384 as ubigint) * (k & 1)))"
    )
    start = "cast(4294967295 as ubigint)"
    return f"xor(list_reduce(list_prepend({start}, {octets}), lambda c, b: {shifted}), {start})"


@query(
    "op13_prefix_trie",
    f"""
    with own as (
        select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
            row_number() over (partition by conv_id order by turn nulls first, role, text) as place
        from conversations where conv_id is not null
    ), whole as (
        select conv_id, list(struct_pack(role, text) order by place) as turns,
            {crc32_sql("cast(conv_id as varchar)")} % 4 as h
        from own group by conv_id
    ), rebuilt as (
        select c.conv_id, list_concat(coalesce(d.turns[1 : c.h], []), c.turns[c.h + 1 :]) as turns
        from whole c left join whole d on d.conv_id = c.conv_id - c.conv_id % 20
    ), prefixes as (
        select conv_id, turns, depth, turns[1 : depth] as prefix
        from (select conv_id, turns, unnest(range(len(turns) + 1)) as depth from rebuilt)
    ), nodes as (
        select prefix, depth, min(conv_id) as conv_id, count(*) as n_convs,
            len(list_filter(regexp_split_to_array(prefix[depth].text, '[\x20\x09-\x0D]+'),
                lambda x: x <> '')) as n_words,
            coalesce(string_agg(cast(conv_id as varchar), ',' order by conv_id)
                filter (where len(turns) = depth), '') as ends
        from prefixes group by prefix, depth
    ), born as (
        select prefix[1 : depth - 1] as prefix, count(*) as n_children
        from nodes where depth > 0 group by 1
    ), described as (
        select n.*, coalesce(n_children, 0) as n_children
        from nodes n left join born b on b.prefix = n.prefix
    ), climbed as (
        select prefix[1 : unnest(range(depth + 1))] as prefix, n_convs, n_words, n_children
        from described
    ), summed as (
        select prefix, count(*) filter (where n_children = 0) as n_leaves,
            cast(sum((n_convs - 1) * coalesce(n_words, 0)) as bigint) as saved_tokens
        from climbed group by prefix
    )
    select n.conv_id, n.depth, p.conv_id as parent_conv_id, n.n_convs, n.n_children, s.n_leaves,
        s.saved_tokens, sha256(n.ends) as ends_sha256
    from described n join summed s on s.prefix = n.prefix
    left join nodes p on n.depth > 0 and p.prefix = n.prefix[1 : n.depth - 1]
    """,
)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    dealt = prefix_trie.deal_turns(prefix_trie.digested(table(spark, sf_dir, "conversations")))
    turns, members = rebuilt_conversations(dealt)
    trie = prefix_trie.prefix_trie(turns, members)
    listed = F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",")
    ends = trie.ends.groupBy("key").agg(F.sha2(listed, 256).alias("_ends"))
    return trie.nodes.join(ends, "key", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("_ends", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )


# Conversations of so many ids in a row borrow from the first; at most so many turns, less one.
BORROWERS, BORROWED = 20, 4


def rebuilt_conversations(dealt: prefix_trie.Dealt) -> tuple[DataFrame, DataFrame]:
    """(turns, members): conversations that begin with turns of another one.

    Conversation c has the first h turns of c - c % 20, then its own after its first h; h is
    crc32(c) % 4. `members` has every conv_id.
    """
    counts = stored(dealt.counts())
    planned = counts.select(
        "conv_id",
        fold("conv_id", BORROWED).alias("h"),
        (F.col("conv_id") - F.col("conv_id") % BORROWERS).alias("_from"),
    )
    lenders = counts.select(F.col("conv_id").alias("_from"), F.col("n").alias("_lent"))
    plan = stored(
        planned.join(lenders, "_from", "left").select(
            "conv_id", "_from", "h", F.least("h", F.coalesce("_lent", F.lit(0))).alias("k")
        )
    )
    placed = stored(dealt.placed(plan.select("conv_id", "h", "k")))
    digest = ["h1", "h2", "n_words"]
    own = placed.filter("place > h").select(
        "conv_id", (F.col("place") - F.col("h") + F.col("k")).alias("place"), *digest
    )
    first = placed.filter((F.col("place") < BORROWED) & (F.col("conv_id") % BORROWERS == 0))
    lent = plan.select("conv_id", "_from", F.col("k").alias("_k")).join(
        first.select(F.col("conv_id").alias("_from"), "place", *digest), "_from"
    )
    lent = lent.filter(F.col("place") <= F.col("_k")).select("conv_id", "place", *digest)
    return own.union(lent), plan.select("conv_id")


# Of one run in so many a code point is dropped, so that the texts hold misspellings.
SLIPS = 31


@query(
    "op12_spelling_trie",
    f"""
    with runs as (
        select doc_id, run, count(*) as n from (
            select coalesce(cast(doc_id as varchar), '') as doc_id,
                translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]{{7,}}')),
                    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as run
            from documents
        ) group by doc_id, run
    ), hashed as (
        select run, n, cast({crc32_sql("doc_id || ':' || run")} as bigint) as h from runs
    ), slipped as (
        select n, case when h % {SLIPS} <> 0 then run
            else substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) end as word
        from hashed
    ), counted as (
        select word, cast(sum(n) as bigint) as n from slipped where length(word) >= 7
        group by word having sum(n) >= 2
    ), cuts as (
        select word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) as cut
        from (select word, n, unnest(range(1, length(word) + 1)) as i from counted)
    ), near as (
        select a.word, b.word as near, b.n as near_n from cuts a join cuts b
            on a.cut = b.cut and a.i = b.i and a.word <> b.word
        union select a.word, b.word, b.n from cuts a join counted b on a.cut = b.word
        union select b.word, a.word, a.n from cuts a join counted b on a.cut = b.word
    ), best as (
        select word, near, near_n, count(*) over (partition by word) as n_near,
            row_number() over (partition by word order by near_n desc, near) as place
        from near
    ), formed as (
        select c.word, c.n, coalesce(n_near, 0) as n_near,
            case when near_n >= 10 * c.n then near end as form,
            case when near_n >= 10 * c.n then near_n end as form_n
        from counted c left join best b on b.word = c.word and place = 1
    ), steps as (
        with recursive climb as (
            select word, word as root, form from formed
            union all
            select s.word, f.word, f.form from climb s join formed f on f.word = s.form
        ) select word, root from climb where form is null
    )
    select f.word, form, root, n, n_near, form_n from formed f join steps s on s.word = f.word
    """,
)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = spelling_trie.word_counts(docs, slip=spelling_trie.one_dropped(SLIPS))
    return spelling_trie.spelling_groups(counted)


NEIGHBOURS, ASKED_EVERY = 5, 50


@query("op11_multi_index")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    found = multi_index.nearest(vectors, lambda vec: vec % ASKED_EVERY == 0, NEIGHBOURS)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")
