import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from matchloom.operators import attempts as at
from matchloom.operators import lifecycle as lc
from matchloom.schemas import state_schema

STATE = state_schema("id")
LOG = ("id long, ts timestamp_ntz, seq long, op string, reason string, expected string, url string, "
       "source string, priority long")
T0 = dt.datetime(2024, 1, 1)
NOW = F.lit(dt.datetime(2024, 2, 1)).cast("timestamp_ntz")


def state_row(key, status="discovered", failures=0, error=None, priority=0, seen=T0):
    return (key, f"u{key}", status, seen, seen, None, None, None, failures, error, "s", priority, seen)


def test_each_command_touches_its_columns_only(spark):
    ops = ["processing", "processed", "failed", "dead", "skipped", "partial"]
    state = spark.createDataFrame([state_row(i, failures=2) for i in range(7)], STATE)
    commands = spark.createDataFrame([(i, op, f"why {op}", None) for i, op in enumerate(ops)],
                                     "id long, op string, reason string, expected string")
    out = {r["id"]: r.asDict() for r in lc.apply_commands(state, commands, "id", NOW).collect()}
    later = dt.datetime(2024, 2, 1)
    stamps = {0: "last_attempted_at", 1: "last_processed_at", 2: "last_failed_at", 5: "last_processed_at"}
    for i, op in enumerate(ops):
        row = out[i]
        assert row["status"] == op and row["last_updated_at"] == later
        for stamp in ("last_attempted_at", "last_processed_at", "last_failed_at"):
            assert row[stamp] == (later if stamps.get(i) == stamp else None)
        assert row["failure_count"] == (3 if op == "failed" else 2)
        assert row["last_error_message"] == (f"why {op}" if op in ("failed", "dead", "skipped") else None)
    assert out[6]["status"] == "discovered" and out[6]["last_updated_at"] == T0


def test_several_commands_on_one_entity_leave_one_row(spark, rows):
    state = spark.createDataFrame([state_row(1), state_row(2)], STATE)
    commands = spark.createDataFrame([(1, 1, "failed", "first", None), (1, 2, "processed", None, None), (1, 2, "processed", None, None)],
                                     "id long, n int, op string, reason string, expected string")
    out = lc.apply_commands(state, commands, "id", NOW, [F.col("n").desc()])
    assert rows(out, "id", "status", "failure_count") == [(1, "processed", 0), (2, "discovered", 0)]


def test_requeue_is_compare_and_set(spark, rows):
    state = spark.createDataFrame([state_row(1, "failed", 3, "boom"), state_row(2, "processed"), state_row(3, "failed", 1)], STATE)
    ids = spark.createDataFrame([(1,), (2,), (1,)], "id long")
    out = lc.requeue(state, ids, "id", "failed", NOW)
    assert rows(out, "id", "status", "failure_count", "last_error_message") == [
        (1, "discovered", 3, "boom"), (2, "processed", 0, None), (3, "failed", 1, None)]
    assert lc.requeue_count(state, ids, "id", "failed").first()[0] == 1
    nobody = ids.filter("id > 9")
    assert lc.requeue_count(state, nobody, "id", "failed").first()[0] == 0


def test_claim_order(spark):
    day = dt.timedelta(days=1)
    state = spark.createDataFrame([
        state_row(1, priority=1, seen=T0 + day), state_row(2, priority=1), state_row(3, priority=5, seen=T0 + 9 * day),
        state_row(4, "failed", priority=9), state_row(5, priority=None), state_row(6, priority=1)], STATE)
    assert [r["id"] for r in lc.claim(state, "id", limit=4).collect()] == [5, 3, 2, 6]


def test_candidates(spark):
    state = spark.createDataFrame([state_row(1, "failed", 3, "boom"), state_row(2, "failed", None, None)], STATE)
    listing = lc.candidate_listing(lc.requeue_candidates(state, "id", "failed"), "id")
    assert [tuple(r) for r in listing.collect()] == [(1, 3, "boom"), (2, 0, "")]
    assert lc.requeue_candidates(state, "id", "failed", only=2).count() == 1
    assert lc.requeue_candidates(state, "id", "failed", limit=1).count() == 1


def test_empty_state_tables_are_listed(spark, rows):
    full = spark.createDataFrame([state_row(1), state_row(2), state_row(3, "dead")], STATE)
    counts = lc.status_counts({"match": full, "demo": full.limit(0)})
    assert rows(counts) == [("demo", None, 0), ("match", "dead", 1), ("match", "discovered", 2)]


def test_stage_outcome(spark, rows):
    parents = spark.createDataFrame([(1,), (2,)], "map_id int")
    children = spark.createDataFrame([(1,), (1,)], "map_id int")
    out = lc.stage_outcome(parents, children, "map_id")
    assert rows(out, "map_id", "child_rows", "op", "reason") == [
        (1, 2, "processed", None), (2, 0, "failed", "Parsing returned no player records")]


def test_rediscovery_keeps_status_and_failures(spark):
    state = spark.createDataFrame([state_row(1, "failed", 3, "boom", priority=5)], STATE)
    items = spark.createDataFrame([(1, "new"), (2, "two")], "id long, url string")
    out = {r["id"]: r for r in lc.discover(state, lc.discovery_rows(items, NOW, "feed", 2), "id").collect()}
    assert (out[1]["status"], out[1]["failure_count"], out[1]["priority"], out[1]["url"]) == ("failed", 3, 5, "new")
    assert out[1]["first_seen_at"] == T0 and out[1]["last_seen_at"] == dt.datetime(2024, 2, 1)
    assert (out[2]["status"], out[2]["failure_count"], out[2]["source"]) == ("discovered", 0, "feed")


def fold(log, state=()):
    """Commands one after another on a dict, as a row store would apply them."""
    table = {r[0]: dict(zip(STATE.names, r)) for r in state}
    for key, ts, _seq, op, reason, expected, url, source, priority in sorted(log, key=lambda r: (r[1], r[2])):
        row = table.get(key)
        if op == "discover":
            if row is None:
                table[key] = dict(zip(STATE.names, (
                    key, url, "discovered", ts, ts, None, None, None, 0, None, source, priority, ts)))
            else:
                row.update(url=url, source=source, last_seen_at=ts, last_updated_at=ts, priority=max(
                    x for x in (row["priority"] or 0, priority) if x is not None))
        elif row is None:
            continue
        elif op == "requeue":
            if row["status"] == expected:
                row.update(status="discovered", last_updated_at=ts)
        else:
            effect = lc.EFFECTS[op]
            row.update(status=op, last_updated_at=ts)
            if effect.stamp:
                row[effect.stamp] = ts
            if effect.keeps_reason:
                row["last_error_message"] = reason if reason is not None else "unknown"
            if effect.counts_failure:
                row["failure_count"] += 1
    return sorted((tuple(r.values()) for r in table.values()), key=repr)


def random_log(seed, size, first_seq=0):
    rng = random.Random(seed)
    ops = ["discover", *lc.EFFECTS, "requeue", "requeue", "requeue"]
    log = []
    for n in range(size):
        key = rng.choice([7] * 6 + list(range(12)))  # one entity holds a third of the log
        op = rng.choice(ops)
        ts = T0 + dt.timedelta(minutes=(first_seq + n) // 3)
        expected = rng.choice(["failed", "dead", "discovered", "processed", "skipped"]) if op == "requeue" else None
        found = op == "discover"
        log.append((key, ts, first_seq + n, op, rng.choice([None, "r1", "r2"]), expected,
                    f"u{n}" if found else None, f"s{n}" if found else None, rng.choice([None, -1, 2, 4]) if found else None))
    return log


@pytest.mark.parametrize("seed", range(6))
def test_replay_equals_one_command_after_another(spark, rows, seed):
    log = random_log(seed, 240)
    shuffled = random.Random(seed).sample(log, len(log))
    assert rows(lc.apply_log(spark.createDataFrame(shuffled, LOG))) == fold(log)


@pytest.mark.parametrize("seed", range(3))
def test_replay_continues_from_a_state(spark, rows, seed):
    early, late = random_log(seed, 90), random_log(seed + 50, 150, first_seq=300)
    state = lc.apply_log(spark.createDataFrame(early, LOG))
    out = lc.apply_log(spark.createDataFrame(late, LOG), state)
    assert rows(out) == fold(early + late)
    few = [r for r in late if r[0] in (2, 7)]
    assert rows(lc.apply_batch(spark.createDataFrame(few, LOG), state)) == fold(early + few)


def test_attempts(spark, rows):
    log = [  # item, attempt, ok, retryable, error
        (1, 1, False, True, "e1"), (1, 2, False, True, "e2"), (1, 3, False, True, "e3" + "x" * 600), (1, 4, True, False, None),
        (2, 1, False, True, "e"), (2, 2, False, True, "e"), (2, 3, True, False, None),
        (3, 1, False, False, "bad"), (3, 2, True, False, None), (4, 1, True, False, None), (5, 1, False, True, "e")]
    df = spark.createDataFrame(log, "item int, n int, ok boolean, retryable boolean, error string")
    out = at.fold_attempts(df, ["item"], [F.col("n")])
    assert rows(out) == [
        (1, "failed", 3, 2, ("e3" + "x" * 600)[:500]), (2, "processed", 3, 2, None), (3, "failed", 1, 0, "bad"),
        (4, "processed", 1, 0, None), (5, "processing", 1, 1, None)]
    assert rows(at.run_summary(out.filter("item = 1"))) == [(1, 0, 1, 2)]
    assert rows(at.run_summary(out.filter("item = 2"))) == [(1, 1, 0, 2)]
