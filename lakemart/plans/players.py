"""Football players: clean text, one row per player, team and league figures, marts."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.functions.scalars import age_group, growth_gap, role_class
from lakemart.operators import aggregates
from lakemart.operators.columns import clean_table, tag_literal
from lakemart.operators.joins import join_group_metrics, join_with_fallback
from lakemart.operators.quality import Check, assert_clean, check_shared_ids, quality_report
from lakemart.operators.ranking import latest_per_key
from lakemart.operators.unions import union_suffixed
from lakemart.sources.schemas import COACH_TYPES, PLAYER_TYPES, TEAM_TYPES
from lakemart.sources.files import scan_csv
from lakemart.sources.sinks import keep_inline, keep_tables

# Columns the profile mart passes through.
PROFILE_COLUMNS = ("player_id", "overall", "potential", "growth_gap", "age", "height_cm", "weight_kg", "value_eur",
                   "wage_eur", "release_clause_eur", "pace", "shooting", "passing", "dribbling", "defending",
                   "physic", "gender", "age_group", "role_classification")


def _player_checks(gender: str) -> list[Check]:
    players, teams, leagues = (f"int_{kind}_{gender}" for kind in ("players", "team_profiles", "league_insights"))
    return [
        Check(players, "unique", "player_id"),
        *[Check(players, "not_null", c) for c in ("player_id", "value_eur", "wage_eur")],
        Check(players, "expression", "wage_eur <= value_eur"),
        Check(teams, "unique", "club_id"),
        *[Check(teams, "not_null", c) for c in ("club_id", "league_id", "avg_overall")],
        Check(teams, "expression", "avg_overall BETWEEN 40 AND 100"),
        Check(leagues, "not_null", "has_talents"),
        Check(leagues, "accepted_values", "has_talents", (True, False)),
    ]


PLAYER_CHECKS = (*_player_checks("male"), *_player_checks("female"))


def stg_players(raw: DataFrame) -> DataFrame:
    return clean_table(raw, PLAYER_TYPES)


def stg_coaches(raw: DataFrame) -> DataFrame:
    return clean_table(raw, COACH_TYPES)


def stg_teams(raw: DataFrame) -> DataFrame:
    return clean_table(raw, TEAM_TYPES)


def int_players_male(staged: DataFrame) -> DataFrame:
    return tag_literal(staged, "gender", "MALE")


def int_players_female(staged: DataFrame, tie_break: Sequence[Column | str] = ()) -> DataFrame:
    """The female files repeat players: the newest row of each stays."""
    return tag_literal(latest_per_key(staged, "player_id", "fifa_update_date", tie_break), "gender", "FEMALE")


def int_team_profiles(players: DataFrame) -> DataFrame:
    return aggregates.team_profiles(players)


def int_league_insights(players: DataFrame, teams: DataFrame) -> DataFrame:
    return join_group_metrics(aggregates.league_players(players), aggregates.league_teams(teams), "league_id")


def mart_player_profiles(players: DataFrame) -> DataFrame:
    return players.withColumns({
        "growth_gap": growth_gap("potential", "overall"),
        "age_group": age_group("age"),
        "role_classification": role_class("player_positions"),
    }).select(*PROFILE_COLUMNS)


def mart_team_dashboard(players: dict[str, DataFrame], teams: dict[str, DataFrame]) -> DataFrame:
    """One row per team of either gender; both arguments map ``male`` and ``female`` to their frames.

    Squad totals, best player and largest gap come from a single grouping of the players.
    """
    measures = ("overall", "potential", "value_eur", "wage_eur", "age")
    squads = union_suffixed(
        {g: df.select("player_id", F.col("club_team_id").alias("club_id"), *measures) for g, df in players.items()},
        ["player_id", "club_id"])
    every_team = union_suffixed(teams, ["club_id"])
    own = {c: F.col(c) for c in ("club_id", "club_name", "league_id")}
    pick = F.coalesce
    return join_with_fallback(every_team, [aggregates.club_metrics(squads)], "club_id", {
        **own,
        "player_count": pick("player_count", F.lit(0)),
        "avg_overall": pick("avg_overall_players", "avg_overall"),
        "avg_potential": pick("avg_potential_players", "total_potential"),
        "total_value": pick("total_value_players", "total_value"),
        "total_wages": pick("total_wages", F.lit(0)),
        "avg_age": pick("avg_age_players", "avg_age"),
        **{c: F.col(c) for c in ("best_player_id", "best_player_overall", "max_overperformance")},
    })


def player_tables(male_raw: DataFrame, female_raw: DataFrame, tie_break: Sequence[Column | str] = (),
                  keep: Callable[[str, DataFrame], DataFrame] = keep_inline) -> dict[str, DataFrame]:
    """Every model of the chain by name; ``keep`` decides how models are kept."""
    out = {"int_players_male": keep("int_players_male", int_players_male(stg_players(male_raw))),
           "int_players_female": keep("int_players_female", int_players_female(stg_players(female_raw), tie_break))}
    squads = {gender: out[f"int_players_{gender}"] for gender in ("male", "female")}
    teams = {}
    for gender, players in squads.items():
        teams[gender] = keep(f"int_team_profiles_{gender}", int_team_profiles(players))
        out[f"int_team_profiles_{gender}"] = teams[gender]
        out[f"int_league_insights_{gender}"] = keep(
            f"int_league_insights_{gender}", int_league_insights(players, teams[gender]))
        # The marts are views: nothing else reads them.
        out[f"mart_player_profiles_{gender}"] = mart_player_profiles(players)
    out["mart_team_dashboard"] = mart_team_dashboard(squads, teams)
    return out


def player_report(tables: Mapping[str, DataFrame]) -> DataFrame:
    """All player checks, and how many ids the male and the female players share."""
    shared = check_shared_ids(tables["int_players_male"], tables["int_players_female"], "player_id")
    counted = shared.agg(F.count("*").alias("violations")).select(
        F.lit("shared_ids").alias("check"), F.lit("int_players").alias("table"), F.lit("player_id").alias("column"),
        "violations")
    return quality_report(tables, PLAYER_CHECKS).unionByName(counted)


def run_players(spark: SparkSession, files: Mapping[str, str], layer: str, tie_break: Sequence[Column | str] = (),
                strict: bool = True) -> dict[str, DataFrame]:
    """From CSV files to the tables of ``layer``; ends with the data checks.

    ``files``: paths by ``male_players``, ``female_players`` and, where there are any, ``male_teams``, ``female_teams``,
    ``male_coaches``, ``female_coaches``. ``strict`` raises on violations, after the tables are written; otherwise
    ``checks`` holds the report.
    """
    keep = keep_tables(layer)
    raw = {name: scan_csv(spark, path) for name, path in files.items()}
    stages = {"teams": stg_teams, "coaches": stg_coaches}
    tables = {f"stg_{name}": keep(f"stg_{name}", stages[name.split("_")[1]](df))
              for name, df in raw.items() if name.split("_")[1] in stages}
    tables |= player_tables(raw["male_players"], raw["female_players"], tie_break, keep)
    tables["mart_team_dashboard"] = keep("mart_team_dashboard", tables["mart_team_dashboard"])
    report = player_report(tables)
    if strict:
        assert_clean(report)
    return tables | {"checks": report}
