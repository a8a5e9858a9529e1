import random
import zlib

import pytest
from helpers import sha, words
from pyspark.sql import functions as F

from marketlake.llm import prefix_trie as pt
from marketlake.llm import queries

TURNS = "conv_id long, turn long, role string, text string"


def brute_nodes(conversations):
    """conv_id -> list of (role, text), to the rows of all nodes with the ids that end there."""
    members = {}
    for conv in sorted(conversations):
        turns = conversations[conv]
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(conv)
    children, leaves, saved = {}, {}, {}
    for node in members:
        children.setdefault(node, 0)
        if node:
            children[node[:-1]] = children.get(node[:-1], 0) + 1
    for node, convs in members.items():
        spare = (len(convs) - 1) * len(words(node[-1][1])) if node else 0
        for d in range(len(node) + 1):
            saved[node[:d]] = saved.get(node[:d], 0) + spare
            leaves[node[:d]] = leaves.get(node[:d], 0) + (children[node] == 0)
    return sorted(
        (
            convs[0], len(node), members[node[:-1]][0] if node else -1, len(convs),
            children[node], leaves[node], saved[node],
            sha(",".join(str(c) for c in convs if len(conversations[c]) == len(node))),
        )
        for node, convs in members.items()
    )


def ordered(rows):
    found = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            order = (turn is not None, turn or 0, role or "", text or "")
            found.setdefault(conv, []).append((order, (role or "", text or "")))
    return {c: [t for _, t in sorted(turns)] for c, turns in found.items()}


def rebuilt(conversations):
    out = {}
    for c, turns in conversations.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = conversations.get(c - c % 20, [])[:h] + turns[h:]
    return out


@pytest.fixture
def query(spark, tmp_path):
    def run(rows, schema=TURNS, extra=()):
        path = tmp_path / "in"
        df = spark.createDataFrame(rows, schema).selectExpr("*", *extra)
        df.write.mode("overwrite").parquet(f"{path}/conversations.parquet")
        got = queries.QUERIES["op13_prefix_trie"](spark, str(path))
        return sorted(tuple(-1 if v is None else v for v in r) for r in got.collect())

    return run


@pytest.fixture
def low_bands(monkeypatch):
    """Bands and blocks so small that short conversations cross many."""
    monkeypatch.setattr(pt, "BAND", 2)
    monkeypatch.setattr(pt, "BLOCK", 4)


def shared_prefixes(rng, n, most):
    rows = []
    pool = [("user", "hi there"), ("user", "hello"), ("assistant", "a b c"), (None, None), ("x", "")]
    for conv in range(n):
        for turn in range(rng.randrange(1, most)):
            rows.append((conv, turn, *rng.choice(pool[: 2 + turn % 4])))
    rng.shuffle(rows)
    return rows


def test_equals_brute_force(query):
    rows = shared_prefixes(random.Random(1), 90, 7)
    assert query(rows) == brute_nodes(rebuilt(ordered(rows)))


def test_bands_and_blocks_change_nothing(query, low_bands):
    rows = shared_prefixes(random.Random(2), 60, 14)
    rows += [(200 + c, t, "user", f"t {t % 3}") for c in range(3) for t in range(37 - c)]
    assert query(rows) == brute_nodes(rebuilt(ordered(rows)))


def test_one_long_conversation(query):
    """Deeper than two bands of bands, with words in every turn."""
    rows = [(1, t, "user", f"turn {t}") for t in range(700)]
    rows += [(2, t, "user", f"turn {t}" if t < 650 else "other") for t in range(651)]
    got = query(rows)
    assert got == brute_nodes(rebuilt(ordered(rows)))
    assert max(r[1] for r in got) >= 650


def test_edge_rows(query):
    rows = [
        (None, 1, "user", "no conversation"),
        (20, None, "user", "first, for its turn is null"),
        (20, 1, None, None),
        (20, 1, None, None),  # a repeated row is a turn of its own
        (25, 1, "user", None),
        (39, 2, "", ""),
        (41, 1, "user", "no lender"),
        (-3, 1, "user", "a negative id"),
        (7, 1, "ab", "c"),
        (8, 1, "a", "bc"),
        (9, 1, "user", "word " * 50_000),
    ]
    rows = [(c, t, r, x) for c, t, r, x in rows]
    want = {c: v for c, v in rebuilt(ordered(r for r in rows if r[0] != -3)).items()}
    h = zlib.crc32(b"-3") % 4  # ids are cut to multiples towards zero
    want[-3] = [("user", "a negative id")][h:]
    assert query(rows) == brute_nodes(want)


def test_empty_table_and_clashing_columns(query):
    assert query([]) == []
    rows = shared_prefixes(random.Random(5), 12, 5)
    extra = ["'a' as key", "'b' as place", "'c' as h1", "'d' as _part", "'e' as n_words"]
    assert query(rows, extra=extra) == brute_nodes(rebuilt(ordered(rows)))


def test_a_common_first_turn_is_not_gathered(spark):
    """The most common parent is looked up by a broadcast of few rows, others by a shuffle."""
    turns = spark.range(4000).select(
        F.col("id").alias("conv_id"),
        F.lit(1).alias("turn"),
        F.lit("user").alias("role"),
        F.when(F.col("id") % 3 == 0, F.concat(F.lit("x"), "id")).otherwise("hello").alias("text"),
    )
    dealt = pt.deal_turns(pt.digested(turns))
    members = dealt.counts().select("conv_id")
    trie = pt.prefix_trie(dealt.placed(), members)
    root = trie.nodes.filter("depth = 0").head()
    assert (root.n_convs, root.n_children, root.n_leaves) == (4000, 1335, 1335)
    common = trie.nodes.filter("depth = 1 and n_convs > 1").collect()
    assert [(r.conv_id, r.parent_conv_id, r.n_convs) for r in common] == [(1, 0, 2666)]
    assert trie.ends.count() == 4000


def test_no_python_in_the_plan(spark):
    from conftest import plan_of

    turns = spark.createDataFrame([(1, 1, "user", "hi")], TURNS)
    dealt = pt.deal_turns(pt.digested(turns))
    plan = plan_of(pt.prefix_trie(dealt.placed(), dealt.counts().select("conv_id")).nodes)
    assert "Python" not in plan and "NestedLoop" not in plan and "Cartesian" not in plan
