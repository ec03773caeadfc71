"""The model graph: what each model reads, and whether it is kept as a view or a table."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchloom.operators import scd2
from matchloom.operators.quality import run_suite
from matchloom.plans import models as m
from matchloom.plans.star_tests import star_tests
from matchloom.sources.tables import materialise, register_views


@dataclass(frozen=True)
class Model:
    make: Callable[..., DataFrame]
    reads: tuple[str, ...]
    table: bool = False
    shared: bool = False  # a view with joins that several models and tests read


# Listed so that every model comes after what it reads.
MODELS = {
    "stg_matches": Model(m.stg_matches, ("source_matches",)),
    "stg_maps": Model(m.stg_maps, ("source_maps",)),
    "stg_players": Model(m.stg_players, ("source_players",)),
    "int_match_player_stats": Model(m.int_match_player_stats, ("stg_players", "stg_maps", "stg_matches"), shared=True),
    "int_player_current_team": Model(m.int_player_current_team, ("int_match_player_stats",), shared=True),
    "fact_matches": Model(m.fact_matches, ("stg_matches", "stg_maps"), table=True),
    "fact_player_map_stats": Model(m.fact_player_map_stats, ("int_match_player_stats",), table=True),
    "dim_players": Model(m.dim_players, ("stg_players",), table=True),
    "dim_maps": Model(m.dim_maps, ("stg_maps",), table=True),
}
SNAPSHOT, ROSTER_DIM = "player_roster_history_snapshot", "dim_player_roster_history"


def build(matches: DataFrame, maps: DataFrame, players: DataFrame, root: str, now: Column,
          history: DataFrame | None = None) -> dict[str, DataFrame]:
    """Build every model below ``root``, then the snapshot run at ``now``.

    Staging views stay lazy; marts, the snapshot and views with joins are written
    once, each to a path of its own, because later models and the tests read them again.
    """
    tables = {"source_matches": matches, "source_maps": maps, "source_players": players}
    for name, model in MODELS.items():
        df = model.make(*[tables[r] for r in model.reads])
        tables[name] = materialise(df, f"{root}/{name}") if model.table or model.shared else df
    current = tables["int_player_current_team"]
    history = history if history is not None else scd2.empty_history(current, "player_id")
    tables[SNAPSHOT] = materialise(
        scd2.scd2_apply(history, current, "player_id", ["team_name"], now), f"{root}/{SNAPSHOT}")
    tables[ROSTER_DIM] = materialise(scd2.roster_dim(tables[SNAPSHOT]), f"{root}/{ROSTER_DIM}")
    return tables


def build_and_test(matches: DataFrame, maps: DataFrame, players: DataFrame, root: str,
                   now: Column) -> tuple[dict[str, DataFrame], DataFrame]:
    """All models, then the report of all declared tests over them."""
    tables = build(matches, maps, players, root, now)
    return tables, run_suite(star_tests(), tables)


def publish_views(tables: Mapping[str, DataFrame]) -> None:
    register_views(tables)


def roster_runs(years: Sequence[int]) -> list[Column]:
    """Snapshot run times at each New Year."""
    return [F.make_timestamp_ntz(F.lit(y), *[F.lit(n) for n in (1, 1, 0, 0, 0)]) for y in years]


def roster_observations(enriched: DataFrame, runs: Sequence[Column]) -> DataFrame:
    """Newest recorded team per player and run."""
    pairs = enriched.select("player_id", "team_name", "map_date", "map_id").filter(
        F.col("player_id").isNotNull() & F.col("team_name").isNotNull())
    return scd2.observe(pairs, "player_id", ["team_name", "map_date"], ["map_date", "map_id"],
                        scd2.first_run_from(F.col("map_date"), runs), {"map_date": "observed_map_date"})
