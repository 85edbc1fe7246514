"""SQL from the driver's tables straight to each query's rows, without any JSON in between.

Rates are whole millionths until the last step, rounded half up.
"""

from __future__ import annotations

from arenalake.registry import queries as q


def rounded(part: str, whole: str) -> str:
    """part / whole in millionths, half up."""
    return f"((2000000 * CAST({part} AS HUGEINT) + {whole}) // (2 * {whole}))"


def rate(millionths: str) -> str:
    return f"CAST({millionths} AS DOUBLE) / 1000000.0"


def text(millionths: str) -> str:
    m = f"CAST({millionths} AS BIGINT)"
    sign = f"CASE WHEN {m} < 0 THEN '-' ELSE '' END"
    return f"{sign} || printf('%d.%06d', abs({m}) // 1000000, abs({m}) % 1000000)"


def label(epoch: str) -> str:
    return (
        f"CASE WHEN {epoch} BETWEEN 1672531200 AND 1735689599 THEN '2023_2024' "
        f"WHEN {epoch} >= 1735689600 THEN '2025_2026' ELSE 'outside_target_windows' END"
    )


def epoch(column: str) -> str:
    days = f"date_diff('day', DATE '1970-01-01', CAST({column} AS DATE))"
    return f"CAST({days} * 86400 + 820540800 AS BIGINT)"


def stamp(seconds: str) -> str:
    return f"CAST(make_timestamp(CAST({seconds} AS BIGINT) * 1000000) AS VARCHAR)"


TARGETS = "('2023_2024', '2025_2026')"

_SEATS = """
numbered AS (
  SELECT *, row_number() OVER (
    PARTITION BY l_orderkey
    ORDER BY (l_partkey * 31 + l_suppkey * 7 + l_linenumber) % 4096 NULLS FIRST, l_partkey NULLS FIRST,
             l_suppkey NULLS FIRST, l_linenumber NULLS FIRST, l_quantity NULLS FIRST,
             l_extendedprice NULLS FIRST, l_discount NULLS FIRST, l_tax NULLS FIRST,
             l_returnflag NULLS FIRST, l_linestatus NULLS FIRST, l_shipdate NULLS FIRST) - 1 AS number
  FROM lineitem
),
seats AS (
  SELECT l_orderkey + (number // 10) * 1099511627776 AS doc_id, number % 10 AS seat, l_suppkey AS hero,
         l_partkey AS part, CAST(l_quantity AS BIGINT) % 30 AS kills, CAST(l_linenumber AS BIGINT) AS deaths,
         CAST(round(l_tax * 100) AS BIGINT) AS assists,
         CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END AS won,
         CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS gone,
         CAST(floor(l_extendedprice) AS BIGINT) AS gold, CAST(l_quantity AS BIGINT) * 100 AS xp
  FROM numbered
)"""

_DOCS = f"""
placed AS (
  SELECT *, unnest(range(coalesce((lines + 9) // 10, 1))) AS document
  FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS lines FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey
),
docs AS (
  SELECT o_orderkey + document * 1099511627776 AS match_id, {epoch("o_orderdate")} AS start_time,
         {epoch("o_orderdate")} + copy * 86400 AS loaded,
         CASE WHEN copy = 1 OR o_orderstatus = 'O' THEN 'public_matches'
              WHEN o_orderstatus = 'F' THEN 'pro_matches' ELSE 'unknown' END AS source_stream,
         CASE WHEN o_orderkey % 101 <> 7 THEN {label(epoch("o_orderdate"))} END AS recency_window,
         {label(epoch("o_orderdate"))} AS derived_window,
         CASE WHEN o_orderkey % 97 <> 5 THEN o_orderkey + document * 1099511627776 END AS payload_id,
         CAST(900 + CAST(floor(o_totalprice) AS BIGINT) % 3600 AS BIGINT) AS duration_seconds,
         (o_orderkey % 2 = 0) <> (copy = 1) AS radiant_win,
         o_orderkey % 8 AS lobby_type, o_orderkey % 23 AS game_mode,
         CAST(year(o_orderdate) - 1945 AS BIGINT) AS patch, o_custkey % 10 AS region,
         o_orderkey % 61 AS radiant_score, o_orderkey % 53 AS dire_score,
         CASE WHEN NOT (copy = 1 OR o_orderstatus = 'O') THEN o_custkey % 50 END AS league_id,
         CASE WHEN NOT (copy = 1 OR o_orderstatus = 'O')
              THEN 'League ' || CAST(o_custkey % 50 AS VARCHAR) END AS league_name,
         o_custkey, copy
  FROM placed JOIN (VALUES (0), (1)) AS c(copy) ON copy = 0 OR o_orderpriority = '1-URGENT'
),
ranked AS (
  SELECT *, row_number() OVER (
    PARTITION BY match_id
    ORDER BY CASE source_stream WHEN 'pro_matches' THEN 1 WHEN 'public_matches' THEN 2 ELSE 3 END,
             loaded DESC, source_stream DESC, recency_window DESC) AS rn
  FROM docs
),
fct_match AS (SELECT * FROM ranked WHERE rn = 1 AND payload_id IS NOT NULL)"""

_PLAYER = """
         CASE WHEN part % 10 <> 0 THEN o_custkey * 10 + seat END AS account_id,
         CASE WHEN part % 41 <> 0 THEN seat // 2 + 128 * (seat % 2) END AS player_slot,
         CASE WHEN part % 37 <> 0 THEN hero END AS hero_id,
         kills, deaths, assists,
         CASE WHEN part % 29 <> 0 THEN CAST(won AS BIGINT) END AS win,
         CASE WHEN seat <> 6 THEN seat % 4 + 1 END AS lane_role,
         CASE WHEN part % 3 <> 0 THEN part % 80 END AS rank_tier,
         CAST(gone AS BIGINT) AS leaver_status, gold AS total_gold, xp AS total_xp"""

_PLAYERS = f"""
fct_player AS (
  SELECT CAST(match_id AS VARCHAR) || '-' || CAST(player_slot AS VARCHAR) AS player_match_key,
         *, player_slot < 128 AS is_radiant
  FROM (SELECT match_id, source_stream, recency_window, {_PLAYER}
        FROM ranked JOIN seats ON doc_id = match_id WHERE rn = 1)
  WHERE player_slot IS NOT NULL AND hero_id > 0
),
joined AS (
  SELECT p.player_match_key, p.match_id, p.account_id, p.hero_id, p.win,
         m.recency_window, m.start_time
  FROM fct_player p JOIN fct_match m ON p.match_id = m.match_id
  WHERE m.recency_window IN {TARGETS}
)"""

_HEROES = """
hero_feed AS (
  SELECT s_suppkey AS hero_key, snapshot,
         CASE WHEN s_suppkey % 25 <> 24 THEN s_suppkey END AS hero_id,
         CASE WHEN s_suppkey % 50 <> 3 THEN s_name END AS hero_name,
         CASE s_nationkey % 4 WHEN 0 THEN 'str' WHEN 1 THEN 'agi' WHEN 2 THEN 'int' ELSE 'all' END
           AS primary_attribute,
         CASE WHEN s_suppkey % 2 = 0 THEN 'Melee' ELSE 'Ranged' END AS attack_type,
         CASE s_suppkey % 3 WHEN 0 THEN '["Carry"]' WHEN 1 THEN '["Support","Nuker"]'
              ELSE '["Durable","Initiator","Carry"]' END AS role_list,
         s_suppkey * 3 + snapshot AS pro_pick, s_suppkey + snapshot AS pro_win,
         s_suppkey % 11 AS pro_ban, s_suppkey * 100 AS turbo_picks,
         CASE WHEN s_suppkey % 5 <> 0 THEN s_suppkey * 50 END AS turbo_wins,
         CASE WHEN snapshot = 0 THEN '2025-06-01 00:00:00' ELSE '2025-07-01 00:00:00' END
           AS loaded_at
  FROM supplier JOIN (VALUES (0), (1)) AS c(snapshot) ON snapshot = 0 OR s_acctbal > 3000
),
stg_heroes AS (SELECT * EXCLUDE (hero_key, snapshot) FROM hero_feed WHERE hero_id IS NOT NULL),
dim AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY hero_id ORDER BY loaded_at DESC) AS rn
    FROM stg_heroes)
  WHERE rn = 1
)"""

_MARTS = f"""
totals AS (SELECT recency_window, count(*) AS total FROM joined GROUP BY 1),
hero AS (
  SELECT j.recency_window, j.hero_id, count(*) AS picks, any_value(total) AS total,
         {rounded("sum(CASE WHEN win = 1 THEN 1 ELSE 0 END)", "count(*)")} AS wr,
         {rounded("count(*)", "any_value(total)")} AS pr
  FROM joined j JOIN totals t ON j.recency_window = t.recency_window GROUP BY 1, 2
),
deltas AS (
  SELECT c.hero_id, p.picks AS p_picks, c.picks AS c_picks, p.pr AS p_pr, c.pr AS c_pr,
         p.wr AS p_wr, c.wr AS c_wr, c.pr - p.pr AS d_pr, c.wr - p.wr AS d_wr,
         abs(c.pr - p.pr) + abs(c.wr - p.wr) AS score,
         CASE WHEN abs(c.pr - p.pr) < 10000 AND abs(c.wr - p.wr) < 10000 THEN 'stable'
              WHEN abs(c.pr - p.pr) >= 30000 OR abs(c.wr - p.wr) >= 30000 THEN 'volatile'
              ELSE 'watchlist' END AS segment
  FROM hero c JOIN hero p ON c.hero_id = p.hero_id
  WHERE c.recency_window = '2025_2026' AND p.recency_window = '2023_2024'
),
shift AS (
  SELECT CAST(h.hero_id AS VARCHAR) || '-' || h.recency_window AS hero_window_key,
         h.recency_window, h.hero_id, d.hero_name, d.primary_attribute, d.attack_type,
         d.role_list, h.picks, h.wr, h.total, h.pr, x.* EXCLUDE (hero_id)
  FROM hero h LEFT JOIN dim d ON h.hero_id = d.hero_id
  LEFT JOIN deltas x ON h.hero_id = x.hero_id
),
match_side AS (
  SELECT recency_window, count(*) AS match_count,
         {rounded("sum(duration_seconds)", "count(duration_seconds)")} AS mean_seconds,
         {rounded("sum(CASE WHEN radiant_win THEN 1 ELSE 0 END)", "count(*)")} AS radiant,
         count(DISTINCT patch) AS patch_count, count(DISTINCT league_id) AS league_count
  FROM fct_match WHERE recency_window IN {TARGETS} GROUP BY 1
),
summary AS (
  SELECT m.recency_window, match_count, player_row_count, known_account_count,
         distinct_hero_count, (2 * mean_seconds * 1000000 + 60) // 120 AS pico_minutes, radiant,
         patch_count, league_count
  FROM match_side m JOIN (
    SELECT recency_window, count(*) AS player_row_count,
           count(DISTINCT account_id) AS known_account_count,
           count(DISTINCT hero_id) AS distinct_hero_count
    FROM joined GROUP BY 1) p ON m.recency_window = p.recency_window
),
seen AS (
  SELECT account_id, min(start_time) AS first_seen_start_time
  FROM joined WHERE account_id IS NOT NULL GROUP BY 1
),
status AS (
  SELECT j.recency_window, j.account_id,
         max(CASE WHEN first_seen_start_time <
             CASE j.recency_window WHEN '2023_2024' THEN 1672531200 ELSE 1735689600 END
             THEN 1 ELSE 0 END) AS is_returning_account
  FROM joined j JOIN seen s ON j.account_id = s.account_id GROUP BY 1, 2
),
returning_counts AS (
  SELECT recency_window, count(*) AS known, CAST(sum(is_returning_account) AS BIGINT) AS back
  FROM status GROUP BY 1
)"""

_PAGES = f"""
pro AS (
  SELECT o_orderkey AS k, min(o_orderstatus) AS status, {epoch("min(o_orderdate)")} AS st,
         min(o_orderpriority) AS priority
  FROM orders GROUP BY 1
),
entries AS (
  SELECT page_no, row_number() OVER (PARTITION BY page_no ORDER BY k DESC) - 1 AS pos,
         CASE WHEN k % 19 <> 7 THEN k END AS match_id,
         CASE WHEN k % 11 <> 4 THEN st + again * 60 END AS start_time
  FROM (SELECT k, st, again,
               ((SELECT max(o_orderkey) FROM orders) - k) // 100 + 1 + again AS page_no
        FROM pro JOIN (VALUES (0), (1)) AS c(again) ON again = 0 OR priority = '1-URGENT'
        WHERE status = 'F')
),
complete AS (
  SELECT *, {label("start_time")} AS w FROM entries
  WHERE match_id IS NOT NULL AND start_time IS NOT NULL
),
bounds AS (
  SELECT page_no, count(*) AS entry_count, min(match_id) AS next_less_than_match_id,
         min(start_time) AS oldest_start_time, max(start_time) AS newest_start_time
  FROM entries GROUP BY 1
)"""

_MANIFESTS = f"""
both_manifests AS (
  SELECT o_orderkey AS match_id, {epoch("o_orderdate")} AS start_time,
         'pro_matches' AS source_stream, 1 AS p FROM orders WHERE o_orderstatus = 'F'
  UNION ALL
  SELECT o_orderkey, {epoch("o_orderdate")} + 3600, 'public_matches', 2 FROM orders
  WHERE o_orderstatus = 'O' OR o_orderpriority = '1-URGENT'
),
merged AS (
  SELECT match_id, start_time, source_stream, {label("start_time")} AS recency_window
  FROM (SELECT *, row_number() OVER (
          PARTITION BY match_id ORDER BY p, start_time DESC) AS rn FROM both_manifests)
  WHERE rn = 1
)"""

_BACKFILL = f"""
existing AS (
  SELECT DISTINCT match_id, start_time, source_stream, {label("start_time")} AS w
  FROM both_manifests
  WHERE source_stream = 'pro_matches'
    AND start_time BETWEEN {q.SELECTED_SPAN[0]} AND {q.SELECTED_SPAN[1]}
),
stop AS (
  SELECT coalesce(min(page_no), 9223372036854775807) AS page FROM bounds
  WHERE next_less_than_match_id IS NULL
),
firsts AS (
  SELECT match_id, min_by(start_time, page_no * 4294967296 + pos) AS start_time,
         min_by(w, page_no * 4294967296 + pos) AS w, min(page_no * 4294967296 + pos) AS place
  FROM complete
  WHERE w IN {TARGETS} AND page_no <= (SELECT page FROM stop)
    AND match_id NOT IN (SELECT match_id FROM existing)
  GROUP BY 1
),
added AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY w ORDER BY place) AS rn FROM firsts) f
  WHERE rn <= 300 - (SELECT count(*) FROM existing e WHERE e.w = f.w)
),
chosen AS (
  SELECT match_id, start_time, source_stream, w FROM existing
  UNION ALL SELECT match_id, start_time, 'pro_matches', w FROM added
),
chosen_counts AS (
  SELECT count(*) FILTER (w = '2023_2024') AS n23, count(*) FILTER (w = '2025_2026') AS n25
  FROM chosen
),
ends AS (
  SELECT n23, n25, n23 >= 300 AND n25 >= 300 AS done,
         CASE WHEN n23 >= 300 AND n25 >= 300
              THEN (SELECT coalesce(max(place) // 4294967296, -1) FROM added)
              ELSE (SELECT page FROM stop) END AS until
  FROM chosen_counts
)"""

RAW = (_DOCS,)
CORE = (_DOCS, _SEATS, _PLAYERS)
ALL = (*CORE, _HEROES, _MARTS)
FEED_PAGES = (_PAGES,)
FILL = (_PAGES, _MANIFESTS, _BACKFILL)
#: A first run: nothing has been selected before.
FIRST_FILL = (_PAGES, _MANIFESTS, _BACKFILL.replace("WHERE source_stream = 'pro_matches'", "WHERE false", 1))


def _sql(blocks: tuple[str, ...], select: str) -> str:
    return ("WITH " + ",".join(blocks) if blocks else "") + "\n" + select


_MATCH_COLUMNS = """duration_seconds, radiant_win, lobby_type, game_mode, patch, region,
       radiant_score, dire_score, league_id, league_name"""

_STAGED = f"""payload_id AS match_id, source_stream, recency_window, start_time,
       {stamp("start_time")} AS match_started_at_utc,
       CAST(CAST(make_timestamp(start_time * 1000000) AS DATE) AS VARCHAR) AS match_date,
       {_MATCH_COLUMNS}, {stamp("loaded")} AS loaded_at"""

_NORMALIZED = """
lines AS (
  SELECT *, match_id % 13 = 3 AS legacy,
         CASE WHEN match_id % 13 = 3 THEN 'unknown' ELSE source_stream END AS stream,
         CASE WHEN match_id % 13 = 3 THEN derived_window
              ELSE coalesce(recency_window, derived_window) END AS w
  FROM docs
)"""


def _pivot(kind: str) -> str:
    """Previous and current columns of a hero, null where the hero was not picked."""
    columns = []
    for measure, source in (("hero_picks", "picks"), ("pick_rate", "pr"), ("win_rate", "wr")):
        for side, window in (("previous", "2023_2024"), ("current", "2025_2026")):
            value = f"max({source}) FILTER (recency_window = '{window}')"
            columns.append(
                f"{value if source == 'picks' else rate(value)} AS {side}_window_{measure}"
            )
    return f"SELECT hero_id, {', '.join(columns)} FROM hero GROUP BY 1{kind}"


_DELTAS = f"""p_picks AS previous_window_hero_picks, c_picks AS current_window_hero_picks,
       {rate("p_pr")} AS previous_window_pick_rate, {rate("c_pr")} AS current_window_pick_rate,
       {rate("p_wr")} AS previous_window_win_rate, {rate("c_wr")} AS current_window_win_rate,
       {rate("d_pr")} AS pick_rate_delta_vs_prior_window,
       {rate("d_wr")} AS win_rate_delta_vs_prior_window,
       {rate("score")} AS volatility_score, segment AS stability_segment"""

_MINUTES = "CAST(pico_minutes AS DOUBLE) / 1000000000000.0"


def _counts(rows: list[tuple[str, str, str, str]]) -> str:
    """Check rows: name, model, column and a scalar query for the failures."""
    return "\nUNION ALL ".join(
        f"SELECT '{check}' AS check_name, '{model}' AS model, '{column}' AS column_name, "
        f"CAST(({failures}) AS BIGINT) AS failures"
        for check, model, column, failures in rows
    )


# Where the models live in the blocks above.
_TABLES = {
    "stg_matches": "(SELECT *, payload_id AS m FROM docs WHERE payload_id IS NOT NULL)",
    "stg_hero_stats": "stg_heroes",
    "dim_heroes": "dim",
    "fct_match": "fct_match",
    "fct_player_match": "fct_player",
    "mart_liveops_summary": "summary",
    "mart_hero_meta_shift": "shift",
    "mart_returning_player_proxy": "returning_counts",
}


def _not_null() -> str:
    from arenalake.operators.quality import NOT_NULL

    return _counts(
        [
            ("not_null", m, c, f"SELECT count(*) FROM {_TABLES[m]} WHERE {c} IS NULL")
            for m, columns in NOT_NULL.items()
            for c in columns
        ]
    )


def _unique() -> str:
    from arenalake.operators.quality import UNIQUE

    keys = {"stg_matches": "match_id", "stg_hero_stats": "hero_id", **UNIQUE}
    return _counts(
        [
            (
                "unique",
                m,
                c,
                f"SELECT count(*) FROM (SELECT {c} FROM {_TABLES[m]} WHERE {c} IS NOT NULL "
                f"GROUP BY {c} HAVING count(*) > 1)",
            )
            for m, c in keys.items()
        ]
    )


def _relationships() -> str:
    from arenalake.operators.quality import RELATIONSHIPS

    return _counts(
        [
            (
                f"relationships_{parent}",
                child,
                key,
                f"SELECT count(*) FROM {_TABLES[child]} WHERE {key} IS NOT NULL AND {key} NOT IN "
                f"(SELECT {parent_key} FROM {_TABLES[parent]})",
            )
            for child, key, parent, parent_key in RELATIONSHIPS
        ]
    )


def _accepted() -> str:
    segments = "('stable', 'watchlist', 'volatile')"
    rules = (
        ("fct_match", "recency_window", "recency_window", TARGETS),
        ("mart_liveops_summary", "recency_window", "recency_window", TARGETS),
        ("mart_hero_meta_shift", "recency_window", "recency_window", TARGETS),
        ("mart_hero_meta_shift", "stability_segment", "segment", segments),
        ("mart_returning_player_proxy", "recency_window", "recency_window", TARGETS),
    )
    return _counts(
        [
            (
                "accepted_values",
                m,
                name,
                f"SELECT count(*) FROM {_TABLES[m]} WHERE {c} NOT IN {values}",
            )
            for m, name, c, values in rules
        ]
    )


_COLUMN_ERROR = "is missing required columns: "
_REPORT_ERRORS = " | ".join(
    (
        f"mart_liveops_summary.csv {_COLUMN_ERROR}PATCH_COUNT, LEAGUE_COUNT",
        "mart_liveops_summary.csv is missing target windows: 2023_2024",
        f"mart_hero_meta_shift.csv {_COLUMN_ERROR}ATTACK_TYPE",
        "mart_hero_meta_shift.csv is missing target windows: 2025_2026",
        "mart_hero_meta_shift.csv does not contain a 2025_2026 hero row with populated "
        "prior/current delta fields.",
    )
)


def all_oracles() -> dict[str, str]:
    at = f"'{q.LOADED_AT}'"
    loaded = _sql(
        (_DOCS, _SEATS),
        f"""SELECT match_id, start_time, source_stream, derived_window AS recency_window,
       duration_seconds AS payload_duration, n AS player_count, {at} AS loaded_at
FROM docs LEFT JOIN (SELECT doc_id, count(*) AS n FROM seats GROUP BY 1)
  ON doc_id = match_id""",
    )
    return {
        "scan_jsonl_payloads": _sql(
            (_DOCS, _NORMALIZED),
            """SELECT NOT legacy AS is_envelope,
       CASE WHEN legacy THEN payload_id ELSE match_id END AS match_id,
       CASE WHEN NOT legacy THEN source_stream END AS source_stream,
       CASE WHEN NOT legacy THEN duration_seconds END AS payload_duration FROM lines""",
        ),
        "load_raw_matches": loaded,
        "stream_raw_ingest": loaded,
        "stream_backfill": _sql(
            FEED_PAGES,
            f"""SELECT match_id, start_time, 'pro_matches' AS source_stream, w AS recency_window
FROM (SELECT *, row_number() OVER (PARTITION BY w ORDER BY place) AS rn
      FROM (SELECT match_id, min_by(start_time, page_no * 4294967296 + pos) AS start_time,
                   min_by(w, page_no * 4294967296 + pos) AS w,
                   min(page_no * 4294967296 + pos) AS place
            FROM complete
            WHERE w IN {TARGETS} AND page_no <= (
              SELECT coalesce(min(page_no), 9223372036854775807) FROM bounds
              WHERE next_less_than_match_id IS NULL)
            GROUP BY 1))
WHERE rn <= 300""",
        ),
        "load_raw_hero_stats": _sql(
            (_HEROES,),
            f"""SELECT DISTINCT hero_id, hero_name, role_list, {at} AS loaded_at FROM hero_feed
WHERE snapshot = 0 AND hero_id IS NOT NULL""",
        ),
        "load_raw_pro_matches": _sql(
            FEED_PAGES,
            f"""SELECT match_id, start_time, w AS recency_window, {at} AS loaded_at
FROM complete""",
        ),
        "scan_manifest": _sql(
            (_MANIFESTS,),
            f"""SELECT match_id, start_time, source_stream, {label("start_time")} AS recency_window
FROM both_manifests WHERE source_stream = 'pro_matches'""",
        ),
        "explode_pages": _sql(
            FEED_PAGES,
            "SELECT page_no, CAST(pos AS INTEGER) AS pos, match_id, start_time FROM entries",
        ),
        "envelope_build": _sql(
            (_MANIFESTS, _DOCS),
            """SELECT m.match_id, m.start_time, m.source_stream, m.recency_window,
       '2026-01-01T00:00:00+00:00' AS ingested_at, d.duration_seconds AS payload_duration
FROM merged m JOIN docs d ON m.match_id = d.match_id AND d.copy = 0
WHERE m.match_id IN (SELECT l_orderkey FROM lineitem)""",
        ),
        "missing_payloads": _sql(
            (_MANIFESTS,),
            "SELECT * FROM merged WHERE match_id NOT IN (SELECT l_orderkey FROM lineitem)",
        ),
        "normalize_envelopes": _sql(
            (_DOCS, _NORMALIZED),
            """SELECT stream AS source_stream, w AS recency_window, payload_id AS match_id,
       start_time FROM lines""",
        ),
        "match_snapshot": _sql(
            (_DOCS, _NORMALIZED),
            f"""SELECT stream AS source_stream, w AS recency_window, payload_id AS match_id,
       start_time, {_MATCH_COLUMNS} FROM lines""",
        ),
        "player_snapshot": _sql(
            (_DOCS, _NORMALIZED, _SEATS),
            f"""SELECT *, coalesce(player_slot, 0) < 128 AS is_radiant FROM (
  SELECT stream AS source_stream, w AS recency_window, payload_id AS match_id, {_PLAYER}
  FROM lines JOIN seats ON doc_id = match_id)""",
        ),
        "hero_rows": _sql(
            (_HEROES,),
            """SELECT DISTINCT hero_id, hero_name, primary_attribute, attack_type, pro_pick, pro_win
FROM hero_feed WHERE snapshot = 0 AND hero_id IS NOT NULL AND hero_name IS NOT NULL""",
        ),
        "size_admission": f"""SELECT * FROM (
  SELECT doc_id, CASE WHEN lang <> 'de' THEN n_chars END AS size FROM documents)
WHERE size IS NULL OR size <= {q.SIZE_BOUND}""",
        "manifest_rows": _sql(
            FEED_PAGES,
            f"""SELECT match_id, start_time, 'pro_matches' AS source_stream, w AS recency_window
FROM complete WHERE w IN {TARGETS}""",
        ),
        "dedupe_matches": _sql(
            FEED_PAGES,
            "SELECT match_id, max(start_time) AS start_time FROM complete GROUP BY 1",
        ),
        "dedupe_limit": _sql(
            FEED_PAGES,
            f"""SELECT match_id, start_time, 'public_matches' AS source_stream,
       {label("start_time")} AS recency_window
FROM (SELECT match_id, max(start_time) AS start_time, min(page_no * 4294967296 + pos) AS place
      FROM complete GROUP BY 1 ORDER BY place LIMIT {q.PUBLIC_LIMIT})""",
        ),
        "manifest_union": _sql((_MANIFESTS,), "SELECT * FROM merged"),
        "manifest_topk": _sql(
            (_MANIFESTS,),
            f"SELECT * FROM merged ORDER BY start_time DESC, match_id DESC LIMIT {q.DETAIL_LIMIT}",
        ),
        "backfill_select": _sql(
            FILL, "SELECT match_id, start_time, source_stream, w AS recency_window FROM chosen"
        ),
        "backfill_counts": _sql(
            FILL,
            """SELECT '2023_2024' AS recency_window, n23 AS selected_count FROM chosen_counts
UNION ALL SELECT '2025_2026', n25 FROM chosen_counts""",
        ),
        "page_bounds": _sql(FEED_PAGES, "SELECT * FROM bounds"),
        "backfill_progress": _sql(
            FILL,
            f"""SELECT n23 AS selected_2023_2024, n25 AS selected_2025_2026,
       CAST(300 AS BIGINT) AS target_2023_2024, CAST(300 AS BIGINT) AS target_2025_2026,
       CASE WHEN n25 < 300 THEN '2025_2026' WHEN n23 < 300 THEN '2023_2024' END
         AS active_backfill_window,
       CASE WHEN done OR NOT EXISTS (SELECT 1 FROM bounds
                                     WHERE next_less_than_match_id IS NULL)
            THEN coalesce((SELECT max_by(next_less_than_match_id, page_no) FROM bounds
                           WHERE page_no < until OR (NOT done AND page_no = until)),
                          {q.SAVED_CURSOR}) END AS next_less_than_match_id,
       (SELECT count(*) FROM bounds WHERE page_no <= until) AS request_count,
       (SELECT max_by(oldest_start_time, page_no) FROM bounds
        WHERE page_no <= until AND oldest_start_time IS NOT NULL) AS oldest_page_start_time,
       (SELECT min_by(newest_start_time, page_no) FROM bounds
        WHERE page_no <= until AND newest_start_time IS NOT NULL) AS newest_page_start_time,
       done AS completed_all_targets
FROM ends""",
        ),
        "stream_backfill_progress": _sql(
            FIRST_FILL,
            """SELECT CASE WHEN done OR NOT EXISTS (SELECT 1 FROM bounds WHERE next_less_than_match_id IS NULL)
            THEN (SELECT max_by(next_less_than_match_id, page_no) FROM bounds
                  WHERE page_no < until OR (NOT done AND page_no = until)) END AS next_less_than_match_id,
       (SELECT count(*) FROM bounds WHERE page_no <= until) AS request_count,
       done AS completed_all_targets
FROM ends""",
        ),
        "stg_matches": _sql(RAW, f"SELECT {_STAGED} FROM docs WHERE payload_id IS NOT NULL"),
        "stg_hero_stats": _sql((_HEROES,), "SELECT * FROM stg_heroes"),
        "dim_heroes": _sql((_HEROES,), "SELECT * FROM dim"),
        "fct_match": _sql(RAW, f"SELECT {_STAGED} FROM fct_match"),
        "selected_payloads": _sql(
            (_DOCS, _SEATS),
            f"""SELECT match_id, source_stream, recency_window, start_time,
       {stamp("loaded")} AS loaded_at, CAST(coalesce(n, 0) AS BIGINT) AS player_count
FROM ranked LEFT JOIN (SELECT doc_id, count(*) AS n FROM seats GROUP BY 1)
  ON doc_id = match_id WHERE rn = 1""",
        ),
        "fct_player_match": _sql(CORE, "SELECT * FROM fct_player"),
        "player_match_join": _sql(CORE, "SELECT * FROM joined"),
        "target_window_filter": _sql(
            RAW,
            f"""SELECT match_id, recency_window, start_time FROM fct_match
WHERE recency_window IN {TARGETS}""",
        ),
        "window_totals": _sql(
            CORE,
            "SELECT recency_window, count(*) AS total_player_rows FROM joined GROUP BY 1",
        ),
        "distinct_counts": _sql(
            CORE,
            """SELECT recency_window, count(*) AS player_row_count,
       count(DISTINCT account_id) AS known_account_count,
       count(DISTINCT hero_id) AS distinct_hero_count FROM joined GROUP BY 1""",
        ),
        "merged_distinct_counts": _sql(
            CORE,
            """SELECT recency_window, count(*) AS player_row_count,
       count(DISTINCT account_id) AS known_account_count,
       count(DISTINCT hero_id) AS distinct_hero_count FROM joined GROUP BY 1""",
        ),
        "approximate_counts": _sql(
            CORE,
            """SELECT recency_window, count(DISTINCT account_id) AS known_account_count,
       count(DISTINCT hero_id) AS distinct_hero_count, true AS accounts_within,
       true AS heroes_within, true AS bytes_bounded FROM joined GROUP BY 1""",
        ),
        "hero_win_rate": _sql(
            ALL, f"SELECT recency_window, hero_id, picks AS hero_picks, {rate('wr')} AS win_rate FROM hero"
        ),
        "hero_pick_rate": _sql(
            ALL,
            f"""SELECT recency_window, hero_id, picks AS hero_picks, {rate("wr")} AS win_rate,
       total AS total_player_rows, {rate("pr")} AS pick_rate FROM hero""",
        ),
        "hero_window_pivot": _sql(ALL, _pivot("")),
        "hero_deltas": _sql(ALL, f"SELECT hero_id, {_DELTAS} FROM deltas"),
        "hero_meta_shift": _sql(
            ALL,
            f"""SELECT hero_window_key, recency_window, hero_id, hero_name, primary_attribute,
       attack_type, role_list, picks AS hero_picks, {rate("wr")} AS win_rate,
       total AS total_player_rows, {rate("pr")} AS pick_rate, {_DELTAS} FROM shift""",
        ),
        "liveops_summary": _sql(
            ALL,
            f"""SELECT recency_window, match_count, player_row_count, known_account_count,
       distinct_hero_count, {_MINUTES} AS avg_match_duration_minutes,
       {rate("radiant")} AS radiant_win_rate, patch_count, league_count FROM summary""",
        ),
        "first_seen": _sql(ALL, "SELECT * FROM seen"),
        "account_window_status": _sql(ALL, "SELECT * FROM status"),
        "returning_players": _sql(
            ALL,
            f"""SELECT recency_window, known AS known_account_count,
       back AS returning_account_count, known - back AS net_new_account_count,
       {rate(rounded("back", "known"))} AS returning_account_rate FROM returning_counts""",
        ),
        "dq_not_null": _sql(
            ALL,
            _not_null(),
        ),
        "dq_unique": _sql(ALL, _unique()),
        "dq_relationships": _sql(ALL, _relationships()),
        "dq_accepted_values": _sql(ALL, _accepted()),
        "dq_suite": _sql(
            ALL,
            f"""SELECT * FROM ({_not_null()})
UNION ALL SELECT * FROM ({_unique()}) WHERE model NOT LIKE 'stg_%'
UNION ALL SELECT * FROM ({_relationships()})
UNION ALL SELECT * FROM ({_accepted()}) WHERE model <> 'fct_match'""",
        ),
        "validate_columns": _sql(
            ALL,
            """SELECT 'mart_liveops_summary' AS mart,
       (SELECT count(*) FROM summary WHERE recency_window = '2025_2026') AS row_count,
       'PATCH_COUNT,LEAGUE_COUNT' AS missing_columns
UNION ALL SELECT 'mart_returning_player_proxy', (SELECT count(*) FROM returning_counts), ''
UNION ALL SELECT 'mart_hero_meta_shift',
       (SELECT count(*) FROM shift WHERE recency_window = '2023_2024'), 'ATTACK_TYPE'""",
        ),
        "validate_windows": _sql(
            ALL,
            """SELECT 'mart_liveops_summary' AS mart, '2023_2024' AS missing_windows
UNION ALL SELECT 'mart_returning_player_proxy',
  concat_ws(',',
    CASE WHEN '2023_2024' NOT IN (SELECT recency_window FROM returning_counts) THEN '2023_2024' END,
    CASE WHEN '2025_2026' NOT IN (SELECT recency_window FROM returning_counts) THEN '2025_2026' END)
UNION ALL SELECT 'mart_hero_meta_shift', '2025_2026'""",
        ),
        "validate_deltas": _sql(
            ALL,
            """SELECT 'complete' AS export, EXISTS (
  SELECT 1 FROM shift WHERE recency_window = '2025_2026' AND segment IS NOT NULL)
  AS has_complete_deltas
UNION ALL SELECT 'incomplete', false""",
        ),
        "validation_report": _sql(
            ALL,
            f"""SELECT 'complete' AS export, '2023_2024,2025_2026' AS target_windows,
       (SELECT count(*) FROM summary) = 2 AND EXISTS (SELECT 1 FROM deltas) AS is_valid,
       '' AS errors
UNION ALL SELECT 'incomplete', '2023_2024,2025_2026', false, '{_REPORT_ERRORS}'""",
        ),
        "export_liveops_summary": _sql(
            ALL,
            f"""SELECT recency_window AS "RECENCY_WINDOW",
       CAST(match_count AS VARCHAR) AS "MATCH_COUNT",
       CAST(player_row_count AS VARCHAR) AS "PLAYER_ROW_COUNT",
       CAST(known_account_count AS VARCHAR) AS "KNOWN_ACCOUNT_COUNT",
       CAST(distinct_hero_count AS VARCHAR) AS "DISTINCT_HERO_COUNT",
       printf('%d.%012d', CAST(pico_minutes // 1000000000000 AS BIGINT),
              CAST(pico_minutes % 1000000000000 AS BIGINT)) AS "AVG_MATCH_DURATION_MINUTES",
       {text("radiant")} AS "RADIANT_WIN_RATE", CAST(patch_count AS VARCHAR) AS "PATCH_COUNT",
       CAST(league_count AS VARCHAR) AS "LEAGUE_COUNT" FROM summary""",
        ),
        "export_hero_meta_shift": _sql(
            ALL,
            f"""SELECT hero_window_key AS "HERO_WINDOW_KEY", recency_window AS "RECENCY_WINDOW",
       CAST(hero_id AS VARCHAR) AS "HERO_ID", hero_name AS "HERO_NAME",
       primary_attribute AS "PRIMARY_ATTRIBUTE", attack_type AS "ATTACK_TYPE",
       role_list AS "ROLE_LIST", CAST(picks AS VARCHAR) AS "HERO_PICKS", {text("wr")} AS "WIN_RATE",
       CAST(total AS VARCHAR) AS "TOTAL_PLAYER_ROWS", {text("pr")} AS "PICK_RATE",
       CAST(p_picks AS VARCHAR) AS "PREVIOUS_WINDOW_HERO_PICKS",
       CAST(c_picks AS VARCHAR) AS "CURRENT_WINDOW_HERO_PICKS",
       {text("p_pr")} AS "PREVIOUS_WINDOW_PICK_RATE", {text("c_pr")} AS "CURRENT_WINDOW_PICK_RATE",
       {text("p_wr")} AS "PREVIOUS_WINDOW_WIN_RATE", {text("c_wr")} AS "CURRENT_WINDOW_WIN_RATE",
       {text("d_pr")} AS "PICK_RATE_DELTA_VS_PRIOR_WINDOW",
       {text("d_wr")} AS "WIN_RATE_DELTA_VS_PRIOR_WINDOW",
       {text("score")} AS "VOLATILITY_SCORE", segment AS "STABILITY_SEGMENT" FROM shift""",
        ),
        "export_returning_players": _sql(
            ALL,
            f"""SELECT recency_window AS "RECENCY_WINDOW",
       CAST(known AS VARCHAR) AS "KNOWN_ACCOUNT_COUNT",
       CAST(back AS VARCHAR) AS "RETURNING_ACCOUNT_COUNT",
       CAST(known - back AS VARCHAR) AS "NET_NEW_ACCOUNT_COUNT",
       {text(rounded("back", "known"))} AS "RETURNING_ACCOUNT_RATE" FROM returning_counts""",
        ),
        "dashboard_kpi": _sql(
            ALL,
            f"""SELECT CAST(sum(match_count) AS BIGINT) AS match_count,
       CAST(sum(player_row_count) AS BIGINT) AS player_row_count,
       CAST(sum(known_account_count) AS BIGINT) AS known_account_count,
       avg({_MINUTES}) AS avg_match_duration_minutes FROM summary""",
        ),
        "window_summary": _sql(
            ALL,
            f"""SELECT s.recency_window, match_count, player_row_count, known_account_count,
       distinct_hero_count, {_MINUTES} AS avg_match_duration_minutes,
       {rate("radiant")} AS radiant_win_rate, patch_count, league_count,
       back AS returning_account_count, known - back AS net_new_account_count,
       {rate(rounded("back", "known"))} AS returning_account_rate
FROM summary s JOIN returning_counts r ON s.recency_window = r.recency_window""",
        ),
        "delta_scatter": _sql(
            ALL,
            f"""SELECT hero_id, hero_name, recency_window,
       {rate("d_pr")} AS pick_rate_delta_vs_prior_window,
       {rate("d_wr")} AS win_rate_delta_vs_prior_window, segment AS stability_segment
FROM shift WHERE recency_window = '2025_2026' AND primary_attribute IN ('str', 'agi')
  AND attack_type = 'Melee' AND segment IN ('watchlist', 'volatile')""",
        ),
        "volatility_ranked": _sql(
            ALL,
            f"""SELECT hero_id, hero_name, recency_window, {rate("score")} AS volatility_score,
       segment AS stability_segment FROM shift""",
        ),
        "volatility_ranks": _sql(
            ALL,
            f"""SELECT hero_id, hero_name, recency_window, {rate("score")} AS volatility_score,
       segment AS stability_segment, rank() OVER (ORDER BY score DESC NULLS LAST) AS volatility_rank,
       dense_rank() OVER (ORDER BY score DESC NULLS LAST) AS volatility_dense_rank FROM shift""",
        ),
        "segment_topk": _sql(
            ALL,
            f"""SELECT segment AS stability_segment, CAST(rn AS INTEGER) AS segment_rank, hero_id,
       hero_name, {rate("c_pr")} AS current_window_pick_rate,
       {rate("c_wr")} AS current_window_win_rate
FROM (SELECT *, row_number() OVER (PARTITION BY segment ORDER BY score DESC, hero_id) AS rn
      FROM shift WHERE recency_window = '2025_2026' AND segment IS NOT NULL)
WHERE rn <= {q.TOP_HEROES}""",
        ),
        "action_quadrant": _sql(
            ALL,
            f"""SELECT hero_id, hero_name, recency_window, {rate("score")} AS volatility_score,
       {rate("c_wr")} AS current_window_win_rate, segment AS stability_segment
FROM shift""",
        ),
        "recommended_action": _sql(
            ALL,
            f"""SELECT hero_id, hero_name, segment AS stability_segment,
       CASE segment WHEN 'stable' THEN 'monitor' WHEN 'watchlist' THEN 'targeted investigation'
            ELSE 'balance review' END AS recommended_action,
       CASE WHEN segment = 'stable' AND c_pr >= {int(q.HIGH_USAGE_FROM * 1000000)}
            THEN 'centralization risk'
            WHEN segment = 'volatile' AND d_pr > 0 THEN 'rising: overperformance'
            WHEN segment = 'volatile' AND d_pr < 0 THEN 'declining: underuse' END AS action_focus
FROM shift WHERE recency_window = '2025_2026' AND segment IS NOT NULL""",
        ),
    }
