import random

from pyspark.sql import functions as F

from matchloom.operators import upsert as u

SCHEMA = "k int, v string, born int, rank int, note string"


def test_policies(spark, rows):
    target = spark.createDataFrame([(1, "old", 1, None, "n1"), (2, "old", 1, 7, "n2"), (3, "old", 1, 5, None)], SCHEMA)
    batch = spark.createDataFrame(
        [(1, None, 9, -3, None), (2, "new", 9, 3, "m2"), (4, "new", 9, -4, None)], SCHEMA)
    policy = {"born": "keep", "rank": "greatest", "note": "coalesce"}
    assert rows(u.upsert(target, batch, ["k"], policy)) == [
        (1, None, 1, 0, "n1"), (2, "new", 1, 7, "m2"), (3, "old", 1, 5, None), (4, "new", 9, -4, None)]


def test_repeats_in_a_batch_apply_in_order(spark, rows):
    target = spark.createDataFrame([], SCHEMA)
    batch = spark.createDataFrame(
        [(1, "b", 2, 4, None, 2), (1, "a", 1, None, "first", 1), (1, "c", 3, -1, None, 3)], SCHEMA + ", n int")
    policy = {"born": "keep", "rank": "greatest", "note": "coalesce"}
    out = u.upsert(target, batch, ["k"], policy, [F.col("n")])
    assert rows(out) == [(1, "c", 1, 4, "first")]


def test_columns_the_batch_lacks_are_left_alone(spark, rows):
    target = spark.createDataFrame([(1, "old", 1, 2, "n")], SCHEMA)
    batch = spark.createDataFrame([(1, "new"), (2, "new")], "k int, v string")
    out = u.upsert(target, batch, ["k"], defaults={"rank": F.lit(0)})
    assert rows(out) == [(1, "new", 1, 2, "n"), (2, "new", None, 0, None)]


def _sequential(target, batch):
    table = {r[0]: list(r) for r in target}
    for k, v, born, rank, note, _n in sorted(batch, key=lambda r: r[5]):
        if k not in table:
            table[k] = [k, v, born, rank, note]
        else:
            old = table[k]
            known = [x for x in (old[3] if old[3] is not None else 0, rank) if x is not None]
            table[k] = [k, v, old[2], max(known), note if note is not None else old[4]]
    return sorted((tuple(r) for r in table.values()), key=repr)


def test_matches_one_write_after_another_and_is_idempotent(spark, rows):
    rng = random.Random(5)

    def row(k):
        return (k, rng.choice(["a", "b", None]), rng.randint(0, 9), rng.choice([None, -2, 0, 3, 8]), rng.choice([None, "x", "y"]))

    target = [row(k) for k in range(0, 40, 2)]
    # One key holds a third of the batch.
    batch = [(*row(rng.choice([3] * 20 + list(range(40)))), n) for n in range(200)]
    t = spark.createDataFrame(target, SCHEMA)
    b = spark.createDataFrame(batch, SCHEMA + ", n int")
    policy = {"born": "keep", "rank": "greatest", "note": "coalesce"}
    once = u.upsert(t, b, ["k"], policy, [F.col("n")])
    assert rows(once) == _sequential(target, batch)
    assert rows(u.upsert(t, b, ["k"], policy, [F.col("n")], probe=True)) == rows(once)
    # A null rank counts as 0 from the second write on; nothing else moves.
    again = u.upsert(once, b, ["k"], policy, [F.col("n")])
    assert rows(again.na.fill(0, ["rank"])) == rows(once.na.fill(0, ["rank"]))
    assert rows(u.upsert(again, b, ["k"], policy, [F.col("n")])) == rows(again)


def test_cascade_and_set_null(spark, rows):
    tables = {
        "matches": spark.createDataFrame([(1,), (2,)], "match_id int"),
        "maps": spark.createDataFrame([(10, 1), (20, 2)], "map_id int, match_id int"),
        "players": spark.createDataFrame([(10, 5), (20, 5)], "map_id int, player_id int"),
        "notes": spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "match_id int, body string"),
    }
    keys = spark.createDataFrame([(1,), (9,)], "match_id int")
    out = u.cascade_delete(
        tables, "matches", keys,
        [("maps", "match_id", "matches", "match_id", "cascade"), ("players", "map_id", "maps", "map_id", "cascade"),
         ("notes", "match_id", "matches", "match_id", "set_null")],
        {"matches": ["match_id"], "maps": ["map_id"], "players": ["map_id", "player_id"]})
    assert rows(out["matches"]) == [(2,)]
    assert rows(out["maps"], "map_id", "match_id") == [(20, 2)]
    assert rows(out["players"], "map_id", "player_id") == [(20, 5)]
    assert rows(out["notes"], "match_id", "body") == [(2, "b"), (None, "a"), (None, "c")]
