import inspect

import pytest
from conftest import plan_of
from helpers import DOCS, brute_components, brute_hits, brute_line_dedup, docs_frame
from pyspark.sql import functions as F

import corpus_pipeline
from marketlake.llm import common, raking, ranking
from marketlake.llm.queries import fold, table

SF = "/root/testdata/sf0.001"


def rows_of(df):
    return sorted(((r.doc_id, r.text) for r in df.select("doc_id", "text").collect()), key=str)


def stage(name):
    return dict(corpus_pipeline.STAGES)[name]


def test_names_and_signatures():
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality_classifier", "line_dedup", "near_duplicates", "decontamination", "mixing"]
    for _, f in corpus_pipeline.STAGES:
        assert list(inspect.signature(f).parameters) == ["spark", "docs", "sf_dir"]


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """Each stage's input and output over the given documents, written and read again."""
    docs, out = table(spark, SF, "documents"), {}
    for name, f in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp(name) / "out")
        f(spark, docs, SF).write.parquet(path)
        out[name] = (docs, spark.read.parquet(path))
        docs = out[name][1]
    return out


def test_columns(steps):
    for name, (before, after) in steps.items():
        if name != "mixing":
            assert after.schema.simpleString() == before.schema.simpleString()


def test_quality_stage(spark, steps):
    before, after = steps["quality_classifier"]
    ranked = ranking.rank_quality(before, table(spark, SF, "labels"), train=fold("doc_id", 5) != 0)
    assert rows_of(after) == rows_of(ranked.filter("score >= 0.3"))
    kept = {r.doc_id for r in after.collect()}
    marks = table(spark, SF, "labels").collect()
    right = [(r.doc_id in kept) == (r.quality == 1) for r in marks]
    assert sum(right) > 0.9 * len(right)


def test_line_stage(steps):
    before, after = steps["line_dedup"]
    want = [(i, kept) for i, _, _, kept in brute_line_dedup(rows_of(before))]
    assert rows_of(after) == sorted(want, key=str)
    assert after.filter("n_chars <> length(text)").count() == 0


def test_near_duplicate_stage(steps):
    before, after = steps["near_duplicates"]
    rows = rows_of(before)
    least = brute_components(rows)
    assert rows_of(after) == [(i, t) for i, t in rows if least[i] == i]


def test_decontamination_stage(spark, steps):
    before, after = steps["decontamination"]
    items = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
    windows = {}
    for i, t in rows_of(before):
        windows[i] = brute_hits_fast(t, items)
    assert rows_of(after) == [(i, t) for i, t in rows_of(before) if not windows[i]]


def brute_hits_fast(text, items):
    from helpers import item_words

    doc = item_words(text)
    for _, item in items:
        w = item_words(item)
        n = min(10, len(w))
        spans = {tuple(doc[p : p + n]) for p in range(len(doc) - n + 1)} if n else set()
        if any(tuple(w[s : s + n]) in spans for s in range(len(w) - n + 1)):
            return True
    return False


def test_mixing_stage(steps):
    before, after = steps["mixing"]
    mixed = raking.mix_sources(before)
    assert rows_of(after) == rows_of(mixed.filter("sampled"))
    assert set(after.columns) == {*before.columns, "topic", "n_tokens", "weight", "probability"}


def test_run_returns_the_last_stage(spark, steps):
    assert rows_of(corpus_pipeline.run(spark, SF)) == rows_of(steps["mixing"][1])


EDGE = [(1, None, None, None, None), (2, "", "en", "a", 0), (None, "no id", "en", "a", 5),
        (None, "no id", "en", "a", 5), (3, "a b c " * 30, "de", "a", 1), (3, "a b c " * 30, "de", "a", 1),
        (4, "A b c " * 30, "de", "b", 1), (3, "another text of id three", None, "b", 1)]


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES])
def test_edge_rows_and_empty_tables(spark, name):
    docs = spark.createDataFrame(EDGE, DOCS)
    got = stage(name)(spark, docs, SF)
    kept = rows_of(got)
    if name == "near_duplicates":
        ids = [i for i, _ in kept]
        # Of id 3 one of the equal texts stays, and the unrelated one.
        assert ids.count(3) == 2 and ids.count(None) == 2 and 4 not in ids and len(ids) == 6
        assert len({t for i, t in kept if i == 3}) == 2
    elif name in ("line_dedup", "decontamination"):
        assert len(kept) == len(EDGE)
    assert stage(name)(spark, docs.limit(0), SF).count() == 0
    extra = docs.withColumn("_id", F.lit("x")).withColumn("component_id", F.lit("y"))
    again = stage(name)(spark, extra, SF)
    assert {"_id", "component_id"} <= set(again.columns) and again.filter("_id <> 'x'").count() == 0


def test_mixing_stage_repeats_rows_by_copies(spark):
    rows = [(i, "w " * 300, "en", "large", 600) for i in range(400)]
    rows += [(9000 + i, "w " * 300, "en", "rare", 600) for i in range(2)]
    docs = spark.createDataFrame(rows, DOCS)
    got = stage("mixing")(spark, docs, SF).collect()
    counts = [sum(r.doc_id == 9000 + i for r in got) for i in range(2)]
    want = {r.doc_id: r.copies for r in raking.mix_sources(docs).collect()}
    assert counts == [want[9000], want[9001]] and min(counts) >= 1 and len(got) == sum(want.values())


def test_near_duplicates_of_rows_that_share_an_id(spark):
    """Unrelated texts of one id all stay, each group of linked ones loses all but one."""
    texts = [f"text {k} " + " ".join(f"w{k}x{j}" for j in range(40)) for k in range(6)]
    rows = [(7, t) for t in texts] + [(7, texts[0] + " more"), (7, texts[1]), (9, texts[2]), (1, texts[3])]
    docs = spark.createDataFrame([(i, t, "en", "a", 1) for i, t in rows], DOCS)
    kept = rows_of(stage("near_duplicates")(spark, docs, SF))
    assert len(kept) == 6 and (1, texts[3]) in kept
    groups = [next(k for k, x in enumerate(texts) if t.startswith(x)) for _, t in kept]
    assert sorted(groups) == list(range(6))


def test_mixing_runs_few_and_small_plans(spark):
    """Driver memory goes by plans: a round of raking is three small ones."""
    status = spark._jsparkSession.sharedState().statusStore()
    rows = [(i, "w " * (40 + i % 90), ["en", "de"][i % 2], f"s{i % 5}", 1) for i in range(200)]
    docs = spark.createDataFrame(rows, DOCS)
    rounds = []
    real = raking.updated

    def counted(cells, factors, margin):
        rounds.append(margin)
        out = real(cells, factors, margin)
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Relation [") <= 4  # the cells and one table a margin
        return out

    raking.updated = counted
    try:
        before = status.executionsCount()
        stage("mixing")(spark, docs, SF).count()
        assert status.executionsCount() - before <= len(rounds) + 20
    finally:
        raking.updated = real


@pytest.mark.parametrize("most, shuffled", [(10**6, False), (0, True)])
def test_texts_that_stay_are_not_shuffled(spark, monkeypatch, most, shuffled):
    """The few ids that go are broadcast whatever Spark's own threshold; more than that are joined."""
    monkeypatch.setattr(common, "LISTED", most)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = corpus_pipeline.near_duplicates(
            spark, docs_frame(spark, [(5, "a b"), (3, "A b"), (4, "c"), (None, "c")]), ""
        )
        plan = plan_of(kept)
        assert ("SortMergeJoin" in plan) == shuffled
        assert ("Exchange hashpartitioning" in plan) == shuffled
        assert sorted((r.doc_id for r in kept.collect()), key=str) == [3, 4, None]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
