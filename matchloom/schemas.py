"""Explicit schemas of the raw records, the landed files and the normalised tables."""

from __future__ import annotations

from pyspark.sql import types as T

BOARD = ["match_id", "puuid"]
VERSIONED_BOARD = ["game_version", "match_id", "puuid"]

TRAIT_LIST = T.ArrayType(
    T.StructType(
        [
            T.StructField("name", T.StringType()),
            T.StructField("num_units", T.IntegerType()),
            T.StructField("style", T.IntegerType()),
            T.StructField("tier_current", T.IntegerType()),
            T.StructField("tier_total", T.IntegerType()),
        ]
    )
)

UNIT_LIST = T.ArrayType(
    T.StructType(
        [
            T.StructField("character_id", T.StringType()),
            T.StructField("itemNames", T.ArrayType(T.StringType())),
            T.StructField("name", T.StringType()),
            T.StructField("rarity", T.IntegerType()),
            T.StructField("tier", T.IntegerType()),
        ]
    )
)

RAW_PARTICIPANT = T.StructType(
    [
        T.StructField("puuid", T.StringType()),
        T.StructField("riotIdGameName", T.StringType()),
        T.StructField("riotIdTagline", T.StringType()),
        T.StructField("placement", T.IntegerType()),
        T.StructField("level", T.IntegerType()),
        T.StructField("traits", TRAIT_LIST),
        T.StructField("units", UNIT_LIST),
        T.StructField("total_damage_to_players", T.IntegerType()),
        T.StructField("players_eliminated", T.IntegerType()),
        T.StructField("time_eliminated", T.DoubleType()),
        T.StructField("last_round", T.IntegerType()),
        T.StructField("gold_left", T.IntegerType()),
        T.StructField("companion", T.StructType([T.StructField("content_ID", T.StringType())])),
    ]
)

RAW_MATCH = T.StructType(
    [
        T.StructField("metadata", T.StructType([T.StructField("match_id", T.StringType())])),
        T.StructField(
            "info",
            T.StructType(
                [
                    T.StructField("queue_id", T.IntegerType()),
                    T.StructField("game_datetime", T.LongType()),
                    T.StructField("game_length", T.DoubleType()),
                    T.StructField("game_version", T.StringType()),
                    T.StructField("tft_set_number", T.IntegerType()),
                    T.StructField("participants", T.ArrayType(RAW_PARTICIPANT)),
                ]
            ),
        ),
    ]
)

LANDED_MATCHES = T.StructType(
    [
        T.StructField("match_id", T.StringType()),
        T.StructField("game_datetime", T.LongType()),
        T.StructField("game_length", T.DoubleType()),
        T.StructField("game_version", T.StringType()),
        T.StructField("tft_set_number", T.IntegerType()),
    ]
)

LANDED_PARTICIPANTS = T.StructType(
    [
        T.StructField("match_id", T.StringType()),
        T.StructField("puuid", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("tagline", T.StringType()),
        T.StructField("placement", T.IntegerType()),
        T.StructField("level", T.IntegerType()),
        T.StructField("traits", T.StringType()),
        T.StructField("units", T.StringType()),
        T.StructField("total_damages", T.IntegerType()),
        T.StructField("player_eliminated", T.IntegerType()),
        T.StructField("time_eliminated", T.DoubleType()),
        T.StructField("last_round", T.IntegerType()),
        T.StructField("gold_left", T.IntegerType()),
        T.StructField("companion", T.StringType()),
    ]
)

MATCHES = T.StructType(
    [
        T.StructField("match_id", T.StringType()),
        T.StructField("game_datetime", T.TimestampType()),
        T.StructField("game_duration", T.DoubleType()),
        T.StructField("game_version", T.StringType()),
        T.StructField("tft_set_number", T.IntegerType()),
    ]
)

PARTICIPANTS = T.StructType(
    [
        T.StructField("match_id", T.StringType()),
        T.StructField("puuid", T.StringType()),
        T.StructField("player_name", T.StringType()),
        T.StructField("player_tagline", T.StringType()),
        T.StructField("placement", T.IntegerType()),
        T.StructField("level", T.IntegerType()),
        T.StructField("total_damage_to_players", T.IntegerType()),
        T.StructField("eliminated_player_count", T.IntegerType()),
        T.StructField("time_eliminated", T.DoubleType()),
        T.StructField("last_round", T.IntegerType()),
        T.StructField("gold_left", T.IntegerType()),
        T.StructField("companion", T.StringType()),
    ]
)

TRAITS = T.StructType(
    [
        T.StructField("match_id", T.StringType()),
        T.StructField("puuid", T.StringType()),
        T.StructField("trait_id", T.StringType()),
        T.StructField("num_units", T.IntegerType()),
        T.StructField("current_tier", T.IntegerType()),
        T.StructField("max_tier", T.IntegerType()),
        T.StructField("trait_style", T.IntegerType()),
    ]
)

UNITS = T.StructType(
    [
        T.StructField("match_id", T.StringType()),
        T.StructField("puuid", T.StringType()),
        T.StructField("character_id", T.StringType()),
        T.StructField("slot_idx", T.IntegerType()),
        T.StructField("rarity", T.IntegerType()),
        T.StructField("tier", T.IntegerType()),
        T.StructField("items", T.ArrayType(T.StringType())),
    ]
)

LEDGER = T.StructType(
    [
        T.StructField("loaded_date", T.DateType()),
        T.StructField("last_loaded", T.TimestampType()),
    ]
)

TABLES = {"matches": MATCHES, "participants": PARTICIPANTS, "traits": TRAITS, "units": UNITS}

PRIMARY_KEYS = {
    "matches": ["match_id"],
    "participants": ["match_id", "puuid"],
    "traits": ["match_id", "puuid", "trait_id"],
    "units": ["match_id", "puuid", "character_id", "slot_idx"],
}

# Reference-data document: sets keyed by number, each with its units and traits.
SET_BODY = T.StructType(
    [
        T.StructField(
            "champions",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("apiName", T.StringType()),
                        T.StructField("name", T.StringType()),
                        T.StructField("traits", T.ArrayType(T.StringType())),
                    ]
                )
            ),
        ),
        T.StructField(
            "traits",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("apiName", T.StringType()),
                        T.StructField("name", T.StringType()),
                        T.StructField(
                            "effects",
                            T.ArrayType(T.StructType([T.StructField("minUnits", T.IntegerType())])),
                        ),
                    ]
                )
            ),
        ),
    ]
)
SET_DOCUMENT = T.StructType([T.StructField("sets", T.MapType(T.StringType(), SET_BODY))])

# Name document: {"data": {anything: {"id": ..., "name": ...}}}.
NAME_DOCUMENT = T.StructType(
    [
        T.StructField(
            "data",
            T.MapType(
                T.StringType(),
                T.StructType([T.StructField("id", T.StringType()), T.StructField("name", T.StringType())]),
            ),
        )
    ]
)
