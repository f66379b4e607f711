"""Explicit schemas (DDL text) of the relational tables and of the nested records that arrive in files."""

from __future__ import annotations

USER_PROFILES = (
    "twitter_id string not null, handle string not null, name string, bio string, created_at string,"
    " follower_count bigint, location string, updated_at timestamp_ntz, got_by_keywords array<string>,"
    " can_dm boolean, category string, human_score double, likely_is string, platform string"
)
USER_STATS = (
    "twitter_id string not null, followers bigint, following bigint, statuses bigint, favorites bigint,"
    " listed bigint, media bigint, verified boolean, blue_verified boolean, default_profile boolean,"
    " default_image boolean, sensitive boolean, can_dm boolean, updated_at timestamp_ntz"
)
USER_KEYWORDS = (
    "twitter_id string not null, keyword string not null, search_id string, added_at timestamp_ntz"
)
API_SEARCH_USAGE = (
    "id string, ids_hash string, keyword string not null, items bigint, retries bigint, next_page string,"
    " page bigint, new_profiles bigint, query_at timestamp_ntz, platform string"
)
PROFILES_TO_SCORE = ("twitter_id string not null, handle string, added_at timestamp_ntz")
PROFILE_SCORES = (
    "twitter_id string not null, scored_by string not null, label boolean, reason string,"
    " scored_at timestamp_ntz, audience string"
)
KEYWORD_STATS = (
    "keyword string not null, semantic_tags array<string>, profiles_found bigint, avg_human_score decimal(4,3),"
    " label_rate decimal(4,3), still_valid boolean, pages_searched bigint, high_quality_count bigint,"
    " low_quality_count bigint, first_search_at timestamp_ntz, last_search_at timestamp_ntz,"
    " updated_at timestamp_ntz"
)

TABLES = {
    "user_profiles": USER_PROFILES,
    "user_stats": USER_STATS,
    "user_keywords": USER_KEYWORDS,
    "api_search_usage": API_SEARCH_USAGE,
    "profiles_to_score": PROFILES_TO_SCORE,
    "profile_scores": PROFILE_SCORES,
    "keyword_stats": KEYWORD_STATS,
}

# Keys that the tables must be unique on; used by merges and by the quality checks.
UNIQUE_KEYS = {
    "user_profiles": ["twitter_id"],
    "user_stats": ["twitter_id"],
    "user_keywords": ["twitter_id", "keyword"],
    "api_search_usage": ["keyword", "items", "next_page"],
    "profiles_to_score": ["twitter_id"],
    "profile_scores": ["twitter_id", "scored_by"],
    "keyword_stats": ["keyword"],
}

ACCOUNT_CLASSES = ["Human", "Creator", "Entity", "Other", "Bot"]

RAW_USER_DDL = (
    "struct<rest_id:string,is_blue_verified:boolean,"
    "legacy:struct<screen_name:string,name:string,description:string,created_at:string,location:string,"
    "followers_count:bigint,friends_count:bigint,statuses_count:bigint,favourites_count:bigint,"
    "listed_count:bigint,media_count:bigint,can_dm:boolean,verified:boolean,default_profile:boolean,"
    "default_profile_image:boolean,possibly_sensitive:boolean>,"
    "professional:struct<professional_type:string,"
    "category:array<struct<id:int,name:string,icon_name:string>>>>"
)
SEARCH_PAGE = (f"data array<{RAW_USER_DDL}>, cursor string")
SEARCH_PAGE_WITH_REQUEST = (
    f"keyword string, page bigint, query_at timestamp, platform string, data array<{RAW_USER_DDL}>, cursor string"
)

LABEL_ITEMS_DDL = "array<struct<handle:string,label:boolean,reason:string>>"
BATCH_PROFILE = ("handle string, name string, bio string, category string, followers bigint")
AUDIENCE = (
    "targetProfile string, sector string, highSignals array<string>, lowSignals array<string>,"
    " domainContext string, nullSignals array<string>, notes string"
)

# Columns of the given star-schema tables that are read; the rest stays on disk.
GIVEN_TABLES = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,"
    " l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string,"
    " l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "labels": "doc_id bigint, quality int, toxic int",
}
