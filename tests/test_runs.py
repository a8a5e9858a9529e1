"""Attempts, counters, loading in order, and events."""

import gzip
import json
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from test_pipeline import price_line, write_landed

from marketlake.plans import attempts, planning
from marketlake.plans.run_log import RunFailed, RunLog
from marketlake.registry import sources  # noqa: F401
from marketlake.registry.core import QUERIES
from marketlake.sources import events, landing, sweeps
from marketlake.sources.schemas import RAW_CATALOG, RAW_PRICES
from marketlake.streaming import load

SCOPE = "market_id string, yes_token_id string"
FAILED = "token_id string"


def scope_of(spark, n, prefix="t"):
    rows = [(f"m{i}", f"{prefix}{i}") for i in range(n)] + [("m-none", None)]
    return spark.createDataFrame(rows, SCOPE)


def landed_of(spark, tokens, fidelity=720):
    rows = [(None, "r", "s", t, "m", "c", 1704067200 + k, 0.5, fidelity) for t in tokens for k in range(3)]
    return spark.createDataFrame(rows, RAW_PRICES)


def failed_of(spark, tokens):
    return spark.createDataFrame([(t,) for t in tokens], FAILED)


def todo_of(scope, ledger):
    return sorted(r.yes_token_id for r in attempts.plan_backfill(scope, ledger).collect())


def test_a_second_plan_after_empty_attempts_and_failures(spark, tmp_path):
    ledger = attempts.AttemptLedger(spark, str(tmp_path / "ledger"))
    log = RunLog(spark, str(tmp_path / "runs"))
    scope = scope_of(spark, 22)
    assert len(todo_of(scope, ledger)) == 22
    options = {"ledger": ledger, "log": log, "at": F.lit("2024-01-30 00:00:00")}
    # t0 to t9 landed, t20 and t21 failed (one of them after points had landed), the rest is empty.
    did = attempts.finish_backfill(
        scope, landed_of(spark, [f"t{i}" for i in range(10)] + ["t20", "stranger"]),
        failed_of(spark, ["t20", "t21", "t21"]), run_id="run-1", **options,
    )
    assert did == {
        "markets_targeted": 23, "skipped_no_token": 1, "already_done": 0, "attempted": 22,
        "no_history": 10, "token_failures": 2, "points_landed": 30, "fidelity_720": 10,
    }
    assert todo_of(scope, ledger) == ["t20", "t21"]
    ledger.compact()
    assert todo_of(scope, ledger) == ["t20", "t21"]
    # Half of what is left fails: recorded, then red.
    with pytest.raises(RunFailed, match="1/2"):
        attempts.finish_backfill(
            scope, landed_of(spark, ["t21"], 60), failed_of(spark, ["t20"]), run_id="run-2", **options
        )
    assert todo_of(scope, ledger) == ["t20"]
    counted = {(r.run_id, r.counter): r.value for r in log.read().collect()}
    assert counted["run-2", "already_done"] == 20 and counted["run-2", "fidelity_60"] == 1
    last = {r.token_id: (r.outcome, r.run_id, r.points) for r in ledger.last().collect()}
    assert last["t21"] == ("landed", "run-2", 3) and last["t15"] == ("empty", "run-1", 0)
    assert last["t20"] == ("failed", "run-2", 0) and len(last) == 22


def test_ledger_rules(spark, tmp_path):
    """A failure does not undo a done attempt; a run recorded again replaces itself; a compaction
    without its row does not count."""
    ledger = attempts.AttemptLedger(spark, str(tmp_path / "ledger"))

    def record(run, day, *rows):
        full = [(t, "m", o, None, 0, run, None) for t, o in rows]
        df = spark.createDataFrame(full, attempts.ATTEMPTS)
        ledger.record(df.withColumn("attempted_at", F.lit(f"2024-01-{day}").cast("timestamp")))

    assert ledger.last().count() == 0 and ledger.generation() == 0
    record("a", 10, ("x", "landed"), ("y", "failed"), ("z", "failed"))
    record("b", 11, ("x", "failed"), ("y", "empty"))
    record("b", 11, ("x", "failed"), ("y", "empty"))

    def outcomes():
        return sorted((r.token_id, r.outcome, r.run_id) for r in ledger.last().collect())

    want = [("x", "landed", "a"), ("y", "empty", "b"), ("z", "failed", "a")]
    assert outcomes() == want
    ledger.last().limit(1).write.parquet(str(tmp_path / "ledger/last/generation=1"))  # a crash
    assert outcomes() == want
    ledger.compact()
    assert ledger.generation() == 1 and outcomes() == want
    record("c", 12, ("z", "landed"), ("new", "failed"))
    assert outcomes() == [("new", "failed", "c"), *want[:2], ("z", "landed", "c")]
    assert sorted(r.token_id for r in ledger.done().collect()) == ["x", "y", "z"]


def test_harvest_counters_and_gate(spark, tmp_path):
    log = RunLog(spark, str(tmp_path / "runs"))
    rows = [(f"t{i}", "fetch") for i in range(10)] + [("f1", "fresh"), (None, "no_token")]
    planned = spark.createDataFrame(rows, "yes_token_id string, status string")
    landed = landed_of(spark, ["t1", "t2"])
    did = attempts.finish_harvest(planned, landed, failed_of(spark, ["t1", "f1"]), log=log, run_id="h1")
    assert did == {
        "markets_targeted": 12, "tokens_fetched": 10, "skipped_fresh_watermark": 1,
        "skipped_no_token": 1, "token_failures": 1, "points_landed": 6,
    }  # fmt: skip  # a tenth is tolerated
    with pytest.raises(RunFailed):
        attempts.finish_harvest(planned, landed, failed_of(spark, ["t1", "t2"]), log=log, run_id="h2")
    nothing = planned.limit(0)
    assert attempts.finish_harvest(nothing, landed.limit(0), failed_of(spark, []), log=log, run_id="h3")
    values = {r.run_id: r.value for r in log.read().filter("counter = 'token_failures'").collect()}
    assert values == {"h1": 1, "h2": 2, "h3": 0}


# --- loading --------------------------------------------------------------------------


def files_of(spark, house):
    rows = load.finished_files(spark, str(house), "raw_price_history").collect()
    return {r.name.rsplit("/", 1)[1]: r for r in rows}


def test_oldest_dates_first_and_late_files_too(spark, tmp_path):
    root, house = tmp_path / "land", tmp_path / "house"
    for day, run in ((7, "c"), (5, "a"), (6, "b")):  # landed in no order of dates
        write_landed(root, "raw_price_history", run, [price_line(day)], f"2026-07-0{day}")
    log = RunLog(spark, str(tmp_path / "runs"))
    load.load_pending(spark, str(root), str(house), files_per_batch=1, max_files=2, log=log, run_id="l1")
    assert {n: f.batch for n, f in files_of(spark, house).items()} == {"a.jsonl": 0, "b.jsonl": 1}
    # One lands late for an old date: it goes before what was pending already.
    write_landed(root, "raw_price_history", "late", [price_line(1), "{"], "2026-07-01")
    load.load_pending(spark, str(root), str(house), files_per_batch=1, strict=False, log=log, run_id="l2")
    files = files_of(spark, house)
    assert (files["late.jsonl"].batch, files["c.jsonl"].batch) == (2, 3)
    assert (files["late.jsonl"].rows, files["late.jsonl"].bad_lines) == (1, 1)
    counted = {(r.run_id, r.counter): r.value for r in log.read().collect()}
    assert [counted[r, "files_loaded"] for r in ("l1", "l2")] == [2, 2]
    assert [counted[r, "rows_loaded"] for r in ("l1", "l2")] == [2, 2]
    assert counted["l2", "bad_lines"] == 1 and counted["l2", "files_failed"] == 0


def test_events_are_loaded_on_request_and_nothing_landed_is_nothing_pending(spark, tmp_path):
    root, house = tmp_path / "land", tmp_path / "house"
    results = load.load_pending(spark, str(root), str(house), include_events=True)
    assert set(results) == {"raw_markets", "raw_price_history", "raw_events"}
    assert not any(r.batches or r.failed for r in results.values())


def test_a_planned_batch_is_taken_up_as_it_was(spark, tmp_path):
    """A crash between the rows and the book: the same files go to the same batch again."""
    root, house = tmp_path / "land", tmp_path / "house"
    write_landed(root, "raw_price_history", "b", [price_line(2), price_line(3)], "2026-07-06")
    load.load_pending(spark, str(root), str(house))
    finished = house / "load_files/raw_price_history/finished"
    for f in finished.rglob("*"):
        if f.is_file():
            f.unlink()  # as if it had not been written
    write_landed(root, "raw_price_history", "a", [price_line(1)], "2026-07-05")
    load.load_pending(spark, str(root), str(house))
    assert {n: f.batch for n, f in files_of(spark, house).items()} == {"b.jsonl": 0, "a.jsonl": 1}
    path = load.raw_path(str(house), "raw_price_history")
    assert sorted(r.t for r in load.scan_raw(spark, path, "raw_price_history").collect()) == [1, 2, 3]


def test_a_call_reads_nothing_of_earlier_batches(spark, tmp_path):
    root, house = tmp_path / "land", tmp_path / "house"
    write_landed(root, "raw_price_history", "a", [price_line(1)], "2026-07-05")
    load.load_pending(spark, str(root), str(house))
    path = load.raw_path(str(house), "raw_price_history")
    for f in Path(path).rglob("load_batch=0/**/*.parquet"):
        f.write_bytes(b"not to be read")
        f.with_name(f".{f.name}.crc").unlink(missing_ok=True)
    write_landed(root, "raw_price_history", "b", [price_line(2), price_line(3)], "2026-07-05")
    result = load.load_pending(spark, str(root), str(house))["raw_price_history"]
    assert (result.batches, result.rows, result.files) == ([1], 2, 1)


def test_files_that_break_off_stay_named(spark, tmp_path):
    root, house = tmp_path / "land", tmp_path / "house"
    write_landed(root, "raw_price_history", "a[1]", [price_line(1)])  # a name that is no pattern
    folder = Path(root, "raw/raw_price_history/dt=2026-07-05")
    packed = gzip.compress("".join(f"{price_line(i)}\n" for i in range(20_000)).encode())
    (folder / "half.json.gz").write_bytes(packed[: len(packed) // 2])
    (folder / "none.json.gz").write_bytes(b"no gzip at all")
    (folder / "blank.jsonl").write_text("\n\n")
    with pytest.raises(load.LoadFailed, match="half.json.gz"):
        load.load_pending(spark, str(root), str(house))
    states = {n: f.state for n, f in files_of(spark, house).items()}
    assert states == {"a[1].jsonl": "loaded", "half.json.gz": "partly_read",
                      "none.json.gz": "unreadable", "blank.jsonl": "empty"}
    later = load.load_pending(spark, str(root), str(house))["raw_price_history"]
    assert not later.failed and not later.batches
    assert [n.rsplit("/", 1)[1] for n in later.left_over] == ["half.json.gz", "none.json.gz"]


def test_whole_compressed_files_are_read_once(spark, tmp_path, monkeypatch):
    root, house = tmp_path / "land", tmp_path / "house"
    write_landed(root, "raw_price_history", "a", [price_line(1)])
    folder = Path(root, "raw/raw_price_history/dt=2026-07-05")
    (folder / "whole.json.gz").write_bytes(gzip.compress(f"{price_line(2)}\n{{broken\n".encode()))
    (folder / "blank.json.gz").write_bytes(gzip.compress(b"\n\n"))
    monkeypatch.setattr(load, "broken_off", lambda spark, files: pytest.fail(f"read again: {files}"))
    done = load.load_pending(spark, str(root), str(house), strict=False)["raw_price_history"]
    assert done.error is None and (done.rows, done.bad_lines, done.unreadable_files) == (2, 1, 0)
    states = {n: f.state for n, f in files_of(spark, house).items()}
    assert states == {"a.jsonl": "loaded", "whole.json.gz": "loaded", "blank.json.gz": "empty"}


def test_packed_files_are_small_and_bounded(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(landing, "PACKED_ROWS", 300)
    raw = spark.range(1000).coalesce(1).selectExpr(
        """concat('{"id":"', id, '","question":"will it be so"}') as payload"""
    )
    rows = landing.with_lineage(raw, "r", "s", F.to_timestamp(F.lit("2024-01-31")))
    root, house = str(tmp_path / "land"), str(tmp_path / "house")
    assert landing.land(rows, root, "raw_markets", packed=True)
    files = [f for f in Path(root).rglob("part-*")]
    lines = [len(gzip.decompress(f.read_bytes()).splitlines()) for f in files]
    assert sorted(lines) == [100, 300, 300, 300]
    load.load_pending(spark, root, house)
    back = load.scan_raw(spark, load.raw_path(house, "raw_markets"), "raw_markets")
    assert sorted(r.payload for r in back.collect()) == sorted(r.payload for r in raw.collect())


def test_include_events_leaves_little_on_disk(spark, tmp_path):
    """Landed and loaded, the payloads take less room than they are long: five copies of them."""
    orders = spark.range(3000).selectExpr(
        "id as o_orderkey", "id % 500 as o_custkey", "if(id % 2 = 0, 'F', 'O') as o_orderstatus",
        "id / 7 + 10 as o_totalprice", "timestamp '2024-01-01' + make_interval(0, 0, 0, id % 20)"
        " as o_orderdate", "'5-LOW' as o_orderpriority",
    )
    events = spark.range(1).selectExpr(
        "id as event_id", "id as user_id", "'view' as event_type", "1.0D as value",
        "timestamp '2024-01-01' as ts",
    )
    orders.write.parquet(str(tmp_path / "orders.parquet"))
    events.write.parquet(str(tmp_path / "events.parquet"))
    base = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:"))
    before = set(base.glob("*"))
    got = QUERIES["include_events"](spark, str(tmp_path))
    counts = {(r["include_events"], r["table_name"]): r["count"]
              for r in got.groupBy("include_events", "table_name").count().collect()}
    assert counts == {(False, "raw_markets"): 3000, (True, "raw_markets"): 3000,
                      (True, "raw_events"): 3000}
    length = got.agg(F.sum(F.length("payload"))).first()[0] / 3
    kept = [f for d in set(base.glob("*")) - before for f in d.rglob("part-*")]
    assert {f.name.rsplit(".", 1)[-1] for f in kept if "/raw/" in str(f)} == {"gz"}
    assert sum(f.stat().st_size for f in kept) < length


def test_a_missing_file_is_no_broken_file(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        load.broken_off(spark, [f"file:{tmp_path}/gone.json.gz"])


# --- events ---------------------------------------------------------------------------


def payloads(spark, items, day=5):
    rows = [(None, f"run-{i}", "s", p if isinstance(p, str) else json.dumps(p)) for i, p in enumerate(items)]
    df = spark.createDataFrame(rows, RAW_CATALOG)
    return df.withColumn("_ingested_at", F.lit(f"2026-07-0{day}").cast("timestamp"))


def market(i, updated="2026-07-01T00:00:00Z", **more):
    return {"id": i, "question": f"Q{i}", "updatedAt": updated, **more}


def test_both_sides_of_the_comparison(spark):
    raw = payloads(spark, [market("1"), market("2"), market("3", "2026-07-02T00:00:00Z"), market("4"),
                           market("5"), market("7", None)])
    copies = [market("1"), market("2", question="Other"), market("3"), market("4", "2026-07-09T00:00:00Z"),
              market("6"), market("7")]
    listed = [{"id": "e1", "markets": copies[:3]}, {"id": "e2", "markets": copies[3:] + [None, 5]},
              {"id": "e3", "markets": "no list"}, {"id": "e4"}, "no json", {"id": "e5", "markets": []}]
    got = {r.market_id: r.status for r in events.compare_markets(raw, payloads(spark, listed)).collect()}
    assert got == {"1": "same", "2": "different", "3": "older_in_events", "4": "older_in_markets",
                   "5": "only_markets", "6": "only_events", "7": "older_in_markets"}


def test_the_latest_copy_counts(spark):
    raw = payloads(spark, [market("1")])
    older = payloads(spark, [{"id": "e", "markets": [market("1", question="Old")]}], 4)
    newer = payloads(spark, [{"id": "e", "markets": [market("1")]}], 6)
    both = older.unionByName(newer)
    assert events.market_copies(both).count() == 2
    assert events.compare_markets(raw, both).head().status == "same"


def test_event_arms_have_their_own_floor(spark):
    rows = payloads(spark, [
        {"id": "a", "closed": False, "volume": 5}, {"id": "b", "closed": False, "volume": 50.0},
        {"id": "c", "closed": True, "volume": "70", "endDate": "2026-07-01T00:00:00Z"},
        {"id": "d", "closed": True, "volume": 70, "endDate": "2026-05-01T00:00:00Z"},
        {"id": "e", "volume": 70}, {"id": "f", "closed": False}, {"id": ["g"], "closed": False},
    ])
    found = events.latest_events(rows)
    since = sweeps.closed_since(date(2026, 7, 5))
    arms = {r.event_id: r.sweep for r in sweeps.sweep(found, since=since, volume_floor=10).collect()}
    assert arms == {"b": "open", "c": "recently-closed"}
    full = sweeps.sweep(found, full=True)
    assert sweeps.arm_counters({"events": full}) == {"events_open": 3, "events_closed": 2}


def test_backfill_scope_and_ledger_meet_on_tokens(spark, tmp_path):
    """Markets that share a token are one attempt for both."""
    scope = spark.createDataFrame([("m1", "t"), ("m2", "t"), ("m3", "u")], SCOPE)
    done = spark.createDataFrame([("t",)], FAILED)
    assert [r.market_id for r in planning.backfill_todo(scope, done).collect()] == ["m3"]
