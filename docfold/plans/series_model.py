"""The two-dimension, one-bridge model of series characters and their episodes."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from docfold.functions.documents import TRAILING_DIGITS
from docfold.operators.checks import Check, foreign_key, min_children, not_null, row_count_match, unique
from docfold.specs import BridgeSpec, Column, Field, FlattenSpec, ForeignKey, TableSpec

NOW = "localtimestamp()"

# Databases, tables, columns, widths, paths and check names of the model, in declaration order.
RAW_DATABASE = "raw"
MODEL_DATABASE = "dbo"


def _raw_table(name: str) -> TableSpec:
    columns = (
        Column("id", "int", required=True),
        Column("raw_data", "variant", required=True),
        Column("ingested_at", "timestamp_ntz", default=NOW),
        Column("source_file", width=255),
    )
    return TableSpec(name, columns, key=("id",))


RAW_TABLES = {name: _raw_table(name) for name in ("characters", "episodes")}

DIM_CHARACTERS = TableSpec(
    "dim_characters",
    (
        Column("id", "int", required=True),
        Column("name", width=500, required=True),
        Column("status", width=50),
        Column("species", width=100),
        Column("type", width=100),
        Column("gender", width=50),
        Column("origin_name", width=500),
        Column("origin_url", width=500),
        Column("location_name", width=500),
        Column("location_url", width=500),
        Column("image", width=500),
        Column("url", width=500),
        Column("created", "timestamp_ntz"),
        Column("ingested_at", "timestamp_ntz", default=NOW),
    ),
    key=("id",),
)

DIM_EPISODES = TableSpec(
    "dim_episodes",
    (
        Column("id", "int", required=True),
        Column("name", width=255, required=True),
        Column("episode", width=50, required=True),
        Column("air_date", width=50),
        Column("url", width=500),
        Column("created", "timestamp_ntz"),
        Column("ingested_at", "timestamp_ntz", default=NOW),
    ),
    key=("id",),
)

BRIDGE = TableSpec(
    "bridge_character_episodes",
    (
        Column("character_id", "int", required=True),
        Column("episode_id", "int", required=True),
        Column("created_at", "timestamp_ntz", default=NOW),
    ),
    key=("character_id", "episode_id"),
    foreign_keys=(
        ForeignKey(("character_id",), "dim_characters", ("id",)),
        ForeignKey(("episode_id",), "dim_episodes", ("id",)),
    ),
)

CHARACTER_FIELDS = FlattenSpec(
    (
        Field("$.id", "id", "int"),
        Field("$.name", "name"),
        Field("$.status", "status"),
        Field("$.species", "species"),
        Field("$.type", "type"),
        Field("$.gender", "gender"),
        Field("$.origin.name", "origin_name"),
        Field("$.origin.url", "origin_url"),
        Field("$.location.name", "location_name"),
        Field("$.location.url", "location_url"),
        Field("$.image", "image"),
        Field("$.url", "url"),
        Field("$.created", "created", "timestamp_ntz"),
    ),
    stamp="ingested_at",
)

EPISODE_FIELDS = FlattenSpec(
    (
        Field("$.id", "id", "int"),
        Field("$.name", "name"),
        Field("$.episode", "episode"),
        Field("$.air_date", "air_date"),
        Field("$.url", "url"),
        Field("$.created", "created", "timestamp_ntz"),
    ),
    stamp="ingested_at",
)

CHARACTER_EPISODES = BridgeSpec(
    Field("$.id", "character_id", "int"), "$.episode", "episode_id", "int", TRAILING_DIGITS, stamp="created_at"
)


def series_checks(raw: Mapping[str, DataFrame], model: Mapping[str, DataFrame]) -> list[Check]:
    """The thirteen checks of the model. ``raw`` and ``model`` map table names to their rows."""
    characters, episodes, pairs = (model[t.name] for t in (DIM_CHARACTERS, DIM_EPISODES, BRIDGE))
    bridge_table = BRIDGE.name
    return [
        unique(characters, ["id"], "PK_CHARACTERS_UNIQUE", DIM_CHARACTERS.name),
        unique(episodes, ["id"], "PK_EPISODES_UNIQUE", DIM_EPISODES.name),
        unique(pairs, BRIDGE.key, "PK_BRIDGE_UNIQUE", bridge_table),
        *not_null(
            characters, {"NOT_NULL_CHARACTERS_ID": "id", "NOT_NULL_CHARACTERS_NAME": "name"}, DIM_CHARACTERS.name
        ),
        *not_null(
            episodes,
            {"NOT_NULL_EPISODES_ID": "id", "NOT_NULL_EPISODES_NAME": "name", "NOT_NULL_EPISODES_EPISODE": "episode"},
            DIM_EPISODES.name,
        ),
        foreign_key(pairs, characters, ["character_id"], ["id"], "FK_BRIDGE_TO_CHARACTERS", bridge_table),
        foreign_key(pairs, episodes, ["episode_id"], ["id"], "FK_BRIDGE_TO_EPISODES", bridge_table),
        row_count_match(raw["characters"], characters, "ROW_COUNT_CHARACTERS", DIM_CHARACTERS.name),
        row_count_match(raw["episodes"], episodes, "ROW_COUNT_EPISODES", DIM_EPISODES.name),
        min_children(characters, pairs, ["id"], ["character_id"], "BRIDGE_MIN_EPISODES_PER_CHARACTER", bridge_table),
    ]
