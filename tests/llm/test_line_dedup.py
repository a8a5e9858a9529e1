import random

from helpers import DOCS, brute_line_dedup, docs_frame, sha

from marketlake.llm.line_dedup import dedup_lines

LONG = "A line that is long enough to count as repeated"


def compare(spark, rows):
    df = docs_frame(spark, rows)
    got = sorted(
        ((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in dedup_lines(df).collect()), key=str
    )
    want = [
        (i, n, d, None if text is None else kept)
        for (_, text), (i, n, d, kept) in zip(rows, brute_line_dedup(rows))
    ]
    assert got == sorted(want, key=str)


def test_equals_brute_force(spark):
    rng = random.Random(3)
    pool = [f"line number {k} " + "x" * rng.randrange(20, 60) for k in range(12)] + [LONG, ""]
    rows = []
    for i in range(80):
        lines = [rng.choice(pool) for _ in range(rng.randrange(0, 9))]
        lines = [rng.choice([x, x.upper(), f"  {x}\t"]) for x in lines]
        rows.append((i, "\n".join(lines)))
    compare(spark, rows)


def test_the_largest_document_keeps_all_its_copies(spark):
    rows = [(i, f"{LONG}\nown {i}\n {LONG.upper()} ") for i in range(5)]
    got = {r.doc_id: r for r in dedup_lines(docs_frame(spark, rows)).collect()}
    assert got[4].n_dropped == 0 and got[4].text == rows[4][1]
    assert all(got[i].n_dropped == 2 and got[i].text == f"own {i}" for i in range(4))
    fewer = dedup_lines(docs_frame(spark, rows[:4])).collect()
    assert all(r.n_dropped == 0 for r in fewer)


def test_edge_rows(spark):
    rows = [(0, None), (1, ""), (2, "\n"), (3, LONG + "\n" + LONG)] + [
        (i, LONG) for i in range(4, 9)
    ]
    rows += [(8, "another text of the same id\n" + LONG), (None, LONG), (None, None), (3, LONG)]
    compare(spark, rows)
    got = dedup_lines(docs_frame(spark, rows)).collect()
    dropped = [r for r in got if r.text == "" and r.n_dropped]
    assert all(r.n_lines == r.n_dropped for r in dropped) and dropped


def test_one_id_repeated_is_one_document(spark):
    rows = [(1, f"{LONG}\n{k}") for k in range(9)]
    assert all(r.n_dropped == 0 for r in dedup_lines(docs_frame(spark, rows)).collect())


def test_clashing_columns_and_empty_table(spark):
    extra = ["'a' as _id", "'b' as _pos", "'c' as _lines", "7 as n_lines", "'d' as _row"]
    df = docs_frame(spark, [(i, LONG) for i in range(6)], extra)
    got = dedup_lines(df)
    assert set(got.columns) == set(df.columns) | {"n_dropped"}
    rows = got.collect()
    assert {(r._id, r._pos, r._lines, r._row, r.n_lines) for r in rows} == {("a", "b", "c", "d", 1)}
    assert sorted(r.text for r in rows) == [""] * 5 + [LONG]
    assert dedup_lines(spark.createDataFrame([], DOCS)).count() == 0


def test_many_lines_in_one_document(spark):
    lines = [f"{LONG} {k % 500}" for k in range(20_000)]
    rows = [(9, "\n".join(lines))] + [(i, "\n".join(sorted(set(lines)))) for i in range(5)]
    rows.append((10, f"{LONG} 3"))
    got = {r.doc_id: r for r in dedup_lines(docs_frame(spark, rows)).collect()}
    want = {i: (d, sha(k)) for i, _, d, k in brute_line_dedup(rows)}
    assert {i: (r.n_dropped, sha(r.text)) for i, r in got.items()} == want


def test_no_python_in_the_plan(spark):
    from conftest import plan_of

    plan = plan_of(dedup_lines(docs_frame(spark, ["a"])))
    assert "Python" not in plan and "Arrow" not in plan and "NestedLoop" not in plan
