"""Explicit schemas, as DDL text, of every document and table.

Fixed values: the field names and types below are the exchange format of the landed documents
and have to match it.
"""

from __future__ import annotations

# --- landed documents (bronze), one object per entity ---------------------------------------

USER_PROFILES = (
    "ingested_at STRING, steam_id STRING, game_count BIGINT, "
    "games ARRAY<STRUCT<appid: BIGINT, playtime_forever: BIGINT>>"
)

METADATA_FIELDS = {
    "type": "STRING",
    "name": "STRING",
    "steam_appid": "BIGINT",
    "required_age": "STRING",  # landed both as a number and as text
    "is_free": "BOOLEAN",
    "short_description": "STRING",
    "detailed_description": "STRING",
    "developers": "ARRAY<STRING>",
    "publishers": "ARRAY<STRING>",
    "price_overview": "STRUCT<currency: STRING, initial: BIGINT, final: BIGINT, discount_percent: BIGINT, "
    "initial_formatted: STRING, final_formatted: STRING>",
    "platforms": "STRUCT<windows: BOOLEAN, mac: BOOLEAN, linux: BOOLEAN>",
    "metacritic": "STRUCT<score: BIGINT, url: STRING>",
    "categories": "ARRAY<STRUCT<id: BIGINT, description: STRING>>",
    "genres": "ARRAY<STRUCT<id: STRING, description: STRING>>",
    "recommendations": "STRUCT<total: BIGINT>",
    "release_date": "STRUCT<coming_soon: BOOLEAN, date: STRING>",
}
_METADATA = f"STRUCT<{', '.join(f'{name}: {kind}' for name, kind in METADATA_FIELDS.items())}>"
APP_METADATA = f"ingested_at STRING, app_id STRING, metadata {_METADATA}"

APP_REVIEWS = (
    "ingested_at STRING, app_id STRING, review_count BIGINT, "
    "reviews ARRAY<STRUCT<review_id: STRING, steam_id: STRING, playtime_minutes: BIGINT, voted_up: BOOLEAN, "
    "votes_up: BIGINT, weighted_score: DOUBLE, steam_purchase: BOOLEAN, review_text: STRING>>"
)

# The silver jobs need only these fields; a narrow read schema keeps the JSON parser from building the rest.
# Numbers, flags and ids are read as text and cast value by value: a typed leaf would make the parser flag the whole
# document for one value in another spelling.
GAME_READ = "appid STRING, playtime_forever STRING"
USER_PROFILES_READ = f"ingested_at STRING, steam_id STRING, games ARRAY<STRUCT<{GAME_READ}>>"
APP_METADATA_READ = (
    "ingested_at STRING, app_id STRING, metadata STRUCT<name: STRING, is_free: STRING, "
    "price_overview: STRUCT<final_formatted: STRING>, release_date: STRUCT<date: STRING>, "
    "metacritic: STRUCT<score: STRING>, genres: ARRAY<STRUCT<description: STRING>>, "
    "categories: ARRAY<STRUCT<description: STRING>>>"
)
REVIEW_READ = (
    "review_id STRING, steam_id STRING, playtime_minutes STRING, voted_up STRING, weighted_score STRING, review_text STRING"
)
APP_REVIEWS_READ = f"ingested_at STRING, app_id STRING, reviews ARRAY<STRUCT<{REVIEW_READ}>>"

# --- raw API payloads (text that the shaping jobs parse) -------------------------------------

# Numbers and flags are read as text, so that a value in another spelling is converted and not lost.
LIBRARY_PAYLOAD = "response STRUCT<games: ARRAY<STRUCT<appid: STRING, playtime_forever: STRING>>>"
FRIENDS_PAYLOAD = "friendslist STRUCT<friends: ARRAY<STRUCT<steamid: STRING>>>"
METADATA_PAYLOAD = f"MAP<STRING, STRUCT<success: BOOLEAN, data: {_METADATA}>>"
# success arrives as 1 or true and weighted_vote_score as text or number: both are read as text.
REVIEWS_PAYLOAD = (
    "success STRING, reviews ARRAY<STRUCT<recommendationid: STRING, "
    "author: STRUCT<steamid: STRING, playtime_at_review: STRING>, language: STRING, voted_up: STRING, "
    "votes_up: STRING, weighted_vote_score: STRING, steam_purchase: STRING, review: STRING>>"
)
CATALOGUE_PAYLOAD = "MAP<STRING, STRUCT<appid: BIGINT, ccu: BIGINT>>"

# --- silver and gold -------------------------------------------------------------------------

SILVER_INTERACTIONS = "steam_id STRING, app_id STRING, playtime_minutes BIGINT"
SILVER_METADATA = (
    "app_id STRING, game_name STRING, is_free BOOLEAN, price_formatted STRING, release_date STRING, "
    "metacritic_score BIGINT, genres ARRAY<STRING>, categories ARRAY<STRING>"
)
SILVER_REVIEWS = (
    "app_id STRING, review_id STRING, steam_id STRING, playtime_minutes BIGINT, voted_up BOOLEAN, "
    "weighted_score DOUBLE, review_text STRING"
)
GOLD_MATRIX = "user_index INT, item_index INT, interaction_score FLOAT"
