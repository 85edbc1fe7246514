"""Outer schemas. They are always given, never inferred: inference would read the data twice."""

MANIFEST_COLUMNS = ("match_id", "start_time", "source_stream", "recency_window")
MANIFEST = "match_id bigint, start_time bigint, source_stream string, recency_window string"
ENVELOPE = f"{MANIFEST}, ingested_at string, payload variant"
ENTRY = "struct<match_id:decimal(18,0),start_time:decimal(18,0)>"

RAW_MATCHES = (
    "match_id bigint, start_time bigint, source_stream string, recency_window string, "
    "raw_payload variant, loaded_at timestamp_ntz"
)
RAW_HERO_STATS = "hero_id bigint, raw_payload variant, loaded_at timestamp_ntz"
RAW_PRO_MATCHES = (
    "match_id bigint, start_time bigint, recency_window string, "
    "raw_payload variant, loaded_at timestamp_ntz"
)
RAW_TABLES = {
    "raw_matches": RAW_MATCHES,
    "raw_hero_stats": RAW_HERO_STATS,
    "raw_pro_matches": RAW_PRO_MATCHES,
}
