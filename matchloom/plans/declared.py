"""Further models on the same grains: teams, events, aggregates, histories, completeness."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchloom.functions.scalar import all_present, exact_mean
from matchloom.operators.attempts import fold_attempts
from matchloom.operators.leaderboard import METRIC_SCALE
from matchloom.operators.latest import first_n_by
from matchloom.operators.ordered import with_previous
from matchloom.operators.upsert import upsert
from matchloom.schemas import DEMO_LINKS, MAP_LINKS


def team_match_results(matches: DataFrame) -> DataFrame:
    """Two rows per match, one from each team's side."""
    def side(team: str, opponent: str, made: str, conceded: str) -> Column:
        return F.struct(
            F.col(team).alias("team_name"), F.col(opponent).alias("opponent_team_name"),
            (F.col("match_winner") == F.col(team)).alias("won_match"),
            F.col(made).alias("score_for"), F.col(conceded).alias("score_against"))
    sides = F.array(side("team1", "team2", "score1", "score2"), side("team2", "team1", "score2", "score1"))
    return matches.select("match_id", "event", F.col("date").alias("match_date"), F.explode(sides).alias("s")).select(
        "match_id", "event", "match_date", "s.*")


def player_match_stats(enriched: DataFrame) -> DataFrame:
    """One row per player and match, with totals and means over its maps.

    A player's few maps of a match are laid together before they are added up: sums and means under way are wider than rows.
    """
    rows = enriched.select("match_id", "player_id", "map_order", "map_id", "player_name", "kills", "deaths", "assists", "rating", "adr", "kast",
                           "event", "match_date").repartition("match_id", "player_id")
    return rows.groupBy("match_id", "player_id").agg(
        F.max(F.struct("map_order", "map_id", "player_name"))["player_name"].alias("player_name"),
        F.sum("kills").alias("total_kills"), F.sum("deaths").alias("total_deaths"),
        F.sum("assists").alias("total_assists"),
        *[exact_mean(F.col(c), 4, scale=METRIC_SCALE).alias(f"avg_{c}") for c in ("rating", "adr", "kast")],
        F.max("event").alias("event"), F.max("match_date").alias("match_date"))


def event_matches(matches: DataFrame) -> DataFrame:
    """Match keys under a normalised event name."""
    name = F.regexp_replace(F.trim(F.col("event")), r"\s+", " ")
    return matches.filter(F.col("event").isNotNull()).select(
        name.alias("event_name"), "match_id", F.col("date").alias("match_date"))


def dim_events(matches: DataFrame) -> DataFrame:
    return event_matches(matches).groupBy("event_name").agg(
        F.min("match_date").alias("first_seen_date"), F.max("match_date").alias("last_seen_date"))


def dim_teams(matches: DataFrame) -> DataFrame:
    names = F.explode(F.array("team1", "team2")).alias("team_name")
    return matches.select(names).filter(F.col("team_name").isNotNull()).distinct()


def team_map_win_rate(matches: DataFrame, maps: DataFrame) -> DataFrame:
    """Maps played, maps won and win rate per team and map name."""
    teams = matches.select("match_id", F.explode(F.array("team1", "team2")).alias("team_name"))
    won = F.count_if(F.col("map_winner") == F.col("team_name"))
    played = F.count(F.lit(1))
    return maps.select("match_id", "map_name", "map_winner").join(teams, "match_id").groupBy(
        "team_name", "map_name").agg(
            played.alias("maps_played"), won.alias("maps_won"),
            (won.cast("double") / played.cast("double")).alias("win_rate"))


def player_metrics(enriched: DataFrame) -> DataFrame:
    """Mean kills and matches played per player and map name.

    Matches are first reduced to one row each, so a hot pair is folded before
    the second aggregate.
    """
    per_match = enriched.groupBy("player_id", "map_name", "match_id").agg(
        F.sum("kills").alias("kills"), F.count("kills").alias("n"))
    return per_match.groupBy("player_id", "map_name").agg(
        (F.sum("kills").cast("double") / F.sum("n").cast("double")).alias("average_kills"),
        F.count(F.lit(1)).alias("matches_played"))


def _by_month(moment: str) -> Column:
    return F.date_trunc("month", F.col(moment))


def player_aliases(players: DataFrame, bucket: Column | None = None) -> DataFrame:
    """Each name a player changed to, and when."""
    named = players.filter(F.col("player_id").isNotNull()).select(
        "player_id", "player_name", "inserted_at", "map_id")
    seen = with_previous(named, ["player_id"], ["inserted_at", "map_id"],
                         bucket if bucket is not None else _by_month("inserted_at"), ["player_name"])
    changed = F.col("prev_seen") & ~F.col("player_name").eqNullSafe(F.col("prev_player_name"))
    return seen.filter(changed).select(
        "player_id", F.col("player_name").alias("alias"), F.col("inserted_at").alias("changed_at"), "map_id")


def _team_moves(enriched: DataFrame, bucket: Column | None) -> DataFrame:
    rows = enriched.filter(F.col("player_id").isNotNull() & F.col("team_name").isNotNull()).select(
        "player_id", "player_name", "team_name", "map_date", "map_id")
    seen = with_previous(rows, ["player_id"], ["map_date", "map_id"],
                         bucket if bucket is not None else _by_month("map_date"), ["team_name"])
    return seen.filter(~F.col("prev_seen") | (F.col("team_name") != F.col("prev_team_name")))


def player_transfers(enriched: DataFrame, bucket: Column | None = None) -> DataFrame:
    """Each change of team with the old and the new one."""
    return _team_moves(enriched, bucket).filter("prev_seen").select(
        "player_id", "player_name", F.col("prev_team_name").alias("old_team_name"),
        F.col("team_name").alias("new_team_name"), F.col("map_date").cast("date").alias("transfer_date"), "map_id")


def player_team_history(enriched: DataFrame, bucket: Column | None = None) -> DataFrame:
    """Stints: a run of maps for one team, ended by the first map for the next.

    A stint's end is the start of the next, found by looking back over the
    starts in reverse time.
    """
    starts = _team_moves(enriched, bucket).select("player_id", "player_name", "team_name", "map_date", "map_id")
    mirrored = starts.withColumns({
        "_back": -F.unix_seconds(F.col("map_date").cast("timestamp")), "_back_id": -F.col("map_id")})
    # Two buckets per player and 30 days at most, in reverse order.
    followed = with_previous(mirrored, ["player_id"], ["_back", "_back_id"],
                             F.floor(F.col("_back") / (30 * 86400)), ["map_date"], prefix="next_")
    return followed.select(
        "player_id", "player_name", "team_name", F.col("map_date").cast("date").alias("start_date"),
        F.col("next_map_date").cast("date").alias("end_date"), "map_id")


def scrape_runs(attempts: DataFrame, run: Sequence[str], item: Sequence[str], at: str,
                order_by: Sequence[Column]) -> DataFrame:
    """Roll-up per run: items with their final outcomes, first and last moment.

    ``attempts`` holds every attempt (``ok``, ``retryable``, ``error``). An item
    counts once per run, by the outcome its attempts amount to; one that may
    still be retried is neither a success nor a failure.
    """
    outcomes = fold_attempts(attempts, [*run, *item], order_by).groupBy(*run).agg(
        F.count(F.lit(1)).alias("total_matches"), F.count_if(F.col("status") == "processed").alias("matches_success"),
        F.count_if(F.col("status") == "failed").alias("matches_failed"))
    spans = attempts.groupBy(*run).agg(F.min(at).alias("started_at"), F.max(at).alias("ended_at"))
    return spans.join(outcomes, list(run))


# Fields a row needs to count as complete.
REQUIRED = {
    "matches": ["match_id", "match_url", "team1", "team2", "score1", "score2", "winner", "date", "match_type"],
    "maps": ["map_id", "match_id", "map_url", "map_order", "map_name", "team1_score", "team2_score",
             "map_winner", "date"],
    "players": ["map_id", "player_id", "player_name", "map_name", "team_name", "kills", "deaths", "assists",
                "opening_kills", "opening_deaths", "adr", "kast", "rating"],
}


# Rules of valid values; map rows carry no team names, so their winner is checked against the match elsewhere.
VALID = {
    "matches": [lambda: F.col("score1") >= 0, lambda: F.col("score2") >= 0,
                lambda: F.col("winner").isin(F.col("team1"), F.col("team2"))],
    "maps": [lambda: F.col("team1_score") >= 0, lambda: F.col("team2_score") >= 0, lambda: F.col("map_order").between(1, 5)],
    "players": [lambda: F.least("kills", "deaths", "assists", "opening_kills", "opening_deaths") >= 0],
}


def with_completeness(df: DataFrame, table: str) -> DataFrame:
    """``data_complete`` by rule instead of by declaration: required fields are there and valid."""
    present = all_present(*[F.col(c) for c in REQUIRED[table]])
    valid = [F.coalesce(rule(), F.lit(False)) for rule in VALID[table]]
    return df.withColumn("data_complete", reduce(Column.__and__, valid, present))


TERMINAL = ["processed", "skipped", "dead"]


def match_completeness(matches: DataFrame, map_state: DataFrame) -> DataFrame:
    """``partial`` for a match with a map that is not terminal yet, else ``processed``."""
    done = map_state.groupBy("match_id").agg(
        F.count(F.lit(1)).alias("maps"), F.count_if(F.col("status").isin(*TERMINAL)).alias("maps_done"))
    joined = matches.select("match_id").join(done, "match_id", "left")
    open_maps = F.coalesce(F.col("maps") > F.col("maps_done"), F.lit(False))
    return joined.select(
        "match_id", F.coalesce("maps", F.lit(0)).alias("maps"), F.coalesce("maps_done", F.lit(0)).alias("maps_done"),
        F.when(open_maps, "partial").otherwise("processed").alias("status"))


def winner_mismatches(maps: DataFrame, matches: DataFrame) -> DataFrame:
    """Maps whose winner is neither team of the parent match."""
    teams = matches.select("match_id", "team1", "team2")
    neither = (F.col("map_winner") != F.col("team1")) & (F.col("map_winner") != F.col("team2"))
    return maps.select("map_id", "match_id", "map_winner").join(teams, "match_id").filter(neither)


def incremental_fact(fact: DataFrame, candidates: DataFrame, keys: Sequence[str], watermark: str,
                     look_back: Column | None = None) -> DataFrame:
    """Fact after merging the candidates at least as new as its own newest row.

    ``watermark`` is the audit column (when a row was written), not the date of
    the event. Rows equal to the newest one are merged again, which changes
    nothing; ``look_back`` (an interval) also takes rows that arrive that much
    later than they are stamped. The watermark is a scalar subquery, so nothing
    passes through the driver. An empty fact has none and takes every candidate.
    """
    high = fact.agg(F.max(watermark)).scalar()
    since = high if look_back is None else high - look_back
    newer = candidates.filter(F.coalesce(F.col(watermark) >= since, F.lit(True)))
    return upsert(fact, newer, keys, ordinal=[F.col(watermark)])


def stat_scopes(rows: DataFrame, keys: Sequence[str], scopes: dict[str, dict[str, str]]) -> DataFrame:
    """Wide per-scope columns to one row per scope.

    ``scopes`` maps a scope name to {metric: column}.
    """
    metrics = list(next(iter(scopes.values())))
    parts = F.array(*[
        F.struct(F.lit(scope).alias("stat_scope"), *[F.col(columns[m]).alias(m) for m in metrics])
        for scope, columns in scopes.items()])
    return rows.select(*keys, F.explode(parts).alias("s")).select(*keys, "s.*")


def map_highlights(players: DataFrame, metrics: Sequence[str], top: int = 1) -> DataFrame:
    """Best players per map and metric."""
    long = F.explode(F.array(*[
        F.struct(F.lit(f"most_{m}").alias("highlight_type"), F.col(m).cast("double").alias("value")) for m in metrics]))
    rows = players.select("map_id", "player_id", "player_name", long.alias("h")).select(
        "map_id", "player_id", "player_name", "h.*").filter(F.col("value").isNotNull())
    order = [F.col("value").desc(), F.col("player_id").asc()]
    return first_n_by(rows, ["map_id", "highlight_type"], order, top, "rank")


def links_to_json(matches: DataFrame) -> DataFrame:
    """Follow-up links as JSON arrays of objects; empty arrays where there are none."""
    return matches.withColumns({
        c: F.coalesce(F.to_json(c), F.lit("[]")) for c in ("map_links", "demo_links")})


def links_from_json(matches: DataFrame) -> DataFrame:
    return matches.withColumns({
        "map_links": F.from_json("map_links", MAP_LINKS), "demo_links": F.from_json("demo_links", DEMO_LINKS)})


def normalise_zone(df: DataFrame, columns: Sequence[str], zone: str) -> DataFrame:
    """Naive audit times of one zone to UTC."""
    return df.withColumns({c: F.convert_timezone(F.lit(zone), F.lit("UTC"), F.col(c)) for c in columns})


def recent_matches(matches: DataFrame, size: int = 20, after: tuple[Column, Column] | None = None,
                   event: str | None = None, team: str | None = None) -> DataFrame:
    """One page of matches, newest first; ``after`` is the last (date, id) already shown."""
    rows = matches
    if event is not None:
        rows = rows.filter(F.col("event") == event)
    if team is not None:
        rows = rows.filter((F.col("team1") == team) | (F.col("team2") == team))
    if after is not None:
        moment, key = after
        rows = rows.filter((F.col("date") < moment) | ((F.col("date") == moment) & (F.col("match_id") < key)))
    return rows.orderBy(F.col("date").desc(), F.col("match_id").desc()).limit(size)
