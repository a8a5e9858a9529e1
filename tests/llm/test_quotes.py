import random
import re
from collections import Counter

from conftest import plan_of

from marketlake.llm.quotes import link_conversations

SCHEMA = "conv_id long, turn long, role string, text string"


def linked(spark, rows):
    return link_conversations(spark.createDataFrame(rows, SCHEMA))


def by_turn(spark, rows, conv=1):
    return {r.turn: r for r in linked(spark, rows).collect() if r.conv_id == conv}


TALK = [
    (1, 0, "u", "Hello there.\nHow are you?\n\nA second paragraph."),
    (1, 1, "a", "> Hello there.\n> How are you?\nFine, thanks."),
    (1, 2, "u", "> > Hello THERE. How\n>> are you?\n> Fine, thanks.\n\nGreat!"),
    (1, 3, "a", ">A second paragraph.\nYes."),
    (1, 4, "u", "On its own."),
]


def test_replies_levels_and_order(spark):
    got = by_turn(spark, TALK)
    assert {t: r.parent for t, r in got.items()} == {0: None, 1: 0, 2: 1, 3: 0, 4: None}
    assert {t: (r.thread, r.depth) for t, r in got.items()} == {
        0: (0, 0), 1: (0, 1), 2: (0, 2), 3: (0, 1), 4: (4, 0)}
    assert [got[t].text for t in range(5)] == [TALK[0][3], "Fine, thanks.", "Great!", "Yes.", "On its own."]
    assert [got[t].n_quoted for t in range(5)] == [0, 2, 3, 1, 0]
    assert [(r.conv_id, r.turn) for r in linked(spark, TALK).collect()] == [
        (1, 0), (1, 1), (1, 3), (1, 2), (1, 4)]


def test_the_latest_earlier_message_of_the_conversation(spark):
    rows = [(1, 0, "u", "same words"), (1, 1, "u", "same words"), (1, 2, "a", "> same words\nyes"),
            (1, 3, "u", "same words"), (2, 0, "u", "> same words\nelsewhere"), (1, 5000, "a", ">same  WORDS")]
    got = by_turn(spark, rows)
    assert got[2].parent == 1 and got[5000].parent == 3 and got[5000].text == ""
    other = by_turn(spark, rows, conv=2)[0]
    assert other.parent is None and other.n_quoted == 1 and other.text == "elsewhere"


def test_most_quoted_characters_decide(spark):
    rows = [(1, 0, "u", "a rather long line of text"), (1, 1, "u", "short"),
            (1, 2, "a", "> a rather long line of text\nx\n> short\ny")]
    assert by_turn(spark, rows)[2].parent == 0


def test_edge_rows(spark):
    rows = [(1, 0, "u", None), (1, 1, "u", ""), (1, 2, "u", ">"), (1, 3, None, "> \n>>  > \n"),
            (None, 0, "u", "text"), (None, 1, "u", "> text"), (2, None, "u", "> x"), (3, 0, "u", "a"),
            (3, 1, "u", "> a\nb"), (3, 1, "u", "> a\nb"), (3, 1, "u", "> a\nc")]
    got = linked(spark, rows).collect()
    assert len(got) == len(rows)
    assert {r.text for r in got if r.conv_id == 1} == {None, ""}
    assert all(r.parent is None for r in got if r.conv_id in (None, 1, 2))
    assert sorted((r.text, r.parent) for r in got if r.conv_id == 3 and r.turn == 1) == [
        ("b", 0), ("b", 0), ("c", 0)]
    assert linked(spark, []).count() == 0


def test_a_long_chain_and_long_messages(spark):
    rows = [(1, 0, "u", "message 0")]
    rows += [(1, i, "u", f"> message {i - 1}\nmessage {i}") for i in range(1, 60)]
    rows += [(7, 0, "u", "\n".join(f"line {i}" for i in range(20_000))),
             (7, 1, "u", "\n".join(f"> line {i}" for i in range(20_000)))]
    got = linked(spark, rows).collect()
    assert all(r.depth == r.turn and r.thread == 0 for r in got)
    assert [r.n_quoted for r in got if r.conv_id == 7] == [0, 20_000]


def test_without_quotes_nothing_changes(spark):
    given = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    got = link_conversations(given)
    assert got.select(given.columns).exceptAll(given).count() == 0 and got.count() == given.count()
    assert got.filter("n_quoted > 0 or depth > 0 or thread <> turn").count() == 0


def test_clashing_columns_and_plan(spark):
    df = spark.createDataFrame(TALK, SCHEMA).selectExpr(
        "*", "'c' as _conv", "'l' as _lines", "'h' as hash", "9 as depth", "'r' as _row")
    result = link_conversations(df)
    rows = result.collect()
    assert {(r._conv, r._lines, r.hash, r._row) for r in rows} == {("c", "l", "h", "r")}
    assert {r.depth for r in rows} == {0, 1, 2}
    plan = plan_of(result)
    assert "Python" not in plan and "Arrow" not in plan


def brute(rows):
    """(parent, own text, unlinked lines, n_linked) of each turn of one conversation, by plain loops."""
    def clean(text):
        text = re.sub("[A-Z]", lambda m: m.group().lower(), text)
        return re.sub(r"[\x20\x09-\x0D]+", " ", text).strip(" ")

    def split(text):
        out = []
        for line in text.split("\n"):
            marks = re.match(r"(?:[ \t]*>)+ ?", line)
            out.append((marks.group().count(">") if marks else 0, line[marks.end():] if marks else line))
        return out

    def runs(lines):
        found, run = [], []
        for i, (level, text) in enumerate([*lines, (-1, "")]):
            if run and (level != lines[run[0]][0] or not clean(text)):
                found.append(run)
                run = []
            if clean(text):
                run.append(i)
        return found

    own = {}  # unit -> turns that have it unquoted
    out = {}
    for turn, text in rows:
        lines = split(text)
        units = {}
        for run in runs(lines):
            joined = " ".join(clean(lines[i][1]) for i in run)
            for unit in {joined, *(clean(lines[i][1]) for i in run)}:
                units[lines[run[0]][0], unit] = max(own.get(unit, [-1]))
        linked = {u: s for u, s in units.items() if u[0] > 0 and s >= 0}
        by_source = Counter()
        for (level, unit), source in linked.items():
            by_source[level, source] += len(unit)
        best = max(by_source, key=lambda k: (-k[0], by_source[k], k[1]), default=None)
        texts = {u for _, u in linked}
        unlinked, starts = [], set()
        for run in runs(lines):
            if lines[run[0]][0] > 0:
                joined = " ".join(clean(lines[i][1]) for i in run)
                left = [] if joined in texts else [lines[i][1] for i in run if clean(lines[i][1]) not in texts]
                unlinked += left
                if len(left) < len(run):
                    starts.add(run[0])
        kept = [t for i, (level, t) in enumerate(lines)
                if level == 0 and not (i + 1 in starts and re.search(r"(wrote|said) ?:$", clean(t)))]
        quoted = any(level for level, _ in lines)
        out[turn] = (best[1] if best else None, "\n".join(kept).strip(" \t\n\x0b\f\r") if quoted else text,
                     unlinked, len(linked))
        for (level, unit) in units:
            if level == 0:
                own.setdefault(unit, []).append(turn)
    return out


def test_equals_brute_force(spark):
    """Edited quotes, code with marks, attributions, levels and repeated lines, in random talk."""
    rng = random.Random(9)
    pool = [f"Line {k} of the talk" for k in range(12)] + ["", "yes", "Yes", ">>> print(1)", "Ann wrote:"]
    rows = []
    for turn in range(60):
        lines = []
        for _ in range(rng.randrange(1, 7)):
            line = rng.choice(pool)
            lines.append(rng.choice(["", "", "> ", ">> ", "> > ", ">"]) + line)
        rows.append((turn, "\n".join(lines)))
    got = by_turn(spark, [(1, turn, "u", text) for turn, text in rows])
    want = brute(rows)
    for turn, text in rows:
        r = got[turn]
        assert (r.parent, r.text, r.unlinked, r.n_linked) == want[turn], text


def test_nothing_that_is_said_is_lost(spark):
    rows = [(1, 0, "u", "Hello there."), (1, 1, "a", "On Monday Ann wrote:\n> Hello there.\nHi!"),
            (1, 2, "u", "Try\n>>> print(1)\n> Hallo there, edited.\nBob wrote:\n> nothing known")]
    got = by_turn(spark, rows)
    assert (got[1].text, got[1].unlinked) == ("Hi!", [])
    assert got[2].unlinked == ["print(1)", "Hallo there, edited.", "nothing known"]
    assert got[2].parent is None and got[2].text == "Try\nBob wrote:"
