"""Common table expressions for the SQL counterparts.

They state the derived rows and the models in plain SQL over the generic
tables, without passing through JSON, so they share nothing with the Spark
side but the definition of the data.
"""

from __future__ import annotations

_PARTS: dict[str, tuple[list[str], str]] = {}


# Bounds and labels, highest first; a NULL value has the last label.
DIFFICULTY = """CASE WHEN {value} >= 50 THEN 'common'
                     WHEN {value} >= 20 THEN 'uncommon'
                     WHEN {value} >= 5 THEN 'rare'
                     ELSE 'ultra_rare' END"""
REVIEWS = """CASE WHEN {value} >= 0.95 THEN 'Overwhelmingly Positive'
                  WHEN {value} >= 0.85 THEN 'Very Positive'
                  WHEN {value} >= 0.70 THEN 'Mostly Positive'
                  WHEN {value} >= 0.40 THEN 'Mixed'
                  WHEN {value} >= 0.20 THEN 'Mostly Negative'
                  ELSE 'Overwhelmingly Negative' END"""
PRICES_IN_CENTS = """CASE WHEN {value} >= 4000 THEN 'aaa'
                          WHEN {value} >= 2000 THEN 'premium'
                          WHEN {value} >= 500 THEN 'mid'
                          ELSE 'budget' END"""
TREND = """CASE WHEN {prev} IS NULL THEN 'first_snapshot'
                WHEN {pct} >= 10 THEN 'growing'
                WHEN {pct} <= -10 THEN 'declining'
                ELSE 'stable' END"""


def _cte(name: str, needs: list[str], body: str) -> None:
    _PARTS[name] = (needs, body)


def with_ctes(*names: str) -> str:
    """``WITH ...`` text that defines the named expressions and what they need."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        for need in _PARTS[name][0]:
            visit(need)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        visit(name)
    return "WITH " + ",\n".join(f"{n} AS ({_PARTS[n][1]})" for n in ordered) + "\n"


_cte(
    "d_loads",
    [],
    """SELECT p_partkey AS k, p_size AS z, p_name, p_brand, p_type, unnest(range(0, p_size % 3 + 1)) AS v
       FROM part""",
)
_cte(
    "d_rows",
    ["d_loads"],
    """SELECT 'details-' || k || '-' || v AS load_id,
          CASE WHEN p_brand = 'Brand#5' AND v = 0 THEN NULL
               WHEN p_brand = 'Brand#3' THEN TIMESTAMP '2024-01-01 06:00:00'
               ELSE TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST(v AS INTEGER)) END AS _ingested_at,
          CASE WHEN p_brand = 'Brand#7' AND v = 0 AND z % 3 > 0 THEN NULL ELSE k END AS app_id,
          k, z, v, p_name AS name,
          CASE WHEN z <> 13 THEN p_brand END AS developer,
          p_type AS publisher,
          CASE WHEN k % 7 = 0 THEN 0 ELSE (k * 137 + v * 250) % 6000 END AS cents,
          CASE WHEN k % 13 <> 0 THEN (k % 4) * 10 END AS discount_pct,
          CAST(z * 10 AS BIGINT) AS current_players,
          k % 1000 AS avg_playtime_forever_min,
          k % 100 AS avg_playtime_2weeks_min,
          k % 500 AS median_playtime_forever_min,
          k % 50 AS median_playtime_2weeks_min,
          CASE WHEN k % 11 = 0 THEN 0 WHEN k % 37 <> 4 THEN (k * 31) % 5000 END AS positive_reviews,
          CASE WHEN k % 11 = 0 THEN 0 ELSE (k * 17) % 900 END AS negative_reviews,
          CASE WHEN z = 11 THEN 'n/a' WHEN z = 12 THEN NULL WHEN z = 14 THEN '5000'
               ELSE format('{:,}', z * 10000) || ' .. ' || format('{:,}', z * 20000) END AS owners_range,
          CASE WHEN z = 11 OR z = 12 THEN NULL WHEN z = 14 THEN 5000 ELSE CAST(z AS BIGINT) * 10000 END AS owners_min,
          CASE WHEN z IN (11, 12, 14) THEN NULL ELSE CAST(z AS BIGINT) * 20000 END AS owners_max,
          CASE WHEN p_type = 'SMALL' AND z % 2 = 0 THEN 'Action, Free To Play, '
               WHEN p_type = 'PROMO' AND z % 5 = 0 THEN ''
               WHEN z = 17 THEN NULL
               WHEN z % 4 = 0 THEN p_type || ', Indie'
               ELSE p_type || ', ' || split_part(p_name, ' ', 2) END AS genres,
          'English, French' AS languages,
          z % 8 AS n_tags
       FROM d_loads""",
)
_cte(
    "d_tags",
    ["d_rows"],
    """SELECT load_id, app_id, 'tag' || ((k + i) % 11) AS tag, (k * (i + 3) * 7) % 50 AS votes
       FROM (SELECT load_id, app_id, k, unnest(range(0, n_tags)) AS i FROM d_rows)""",
)
_cte(
    "stg_details",
    ["d_rows"],
    """SELECT *, cents / 100.0 AS price_usd, (cents + (k % 3) * 500) / 100.0 AS initial_price_usd,
          CASE WHEN positive_reviews + negative_reviews <> 0
               THEN positive_reviews / CAST(positive_reviews + negative_reviews AS DOUBLE) END AS review_score
       FROM d_rows WHERE app_id IS NOT NULL
       QUALIFY row_number() OVER (PARTITION BY app_id ORDER BY _ingested_at DESC NULLS FIRST, load_id DESC) = 1""",
)
_cte(
    "s_rows",
    [],
    """SELECT 'store-' || k || '-' || v AS load_id,
          TIMESTAMP '2024-01-02 00:00:00' + to_days(CAST(v AS INTEGER)) AS _ingested_at,
          k AS app_id, k, z, v,
          CASE WHEN z % 2 = 0 THEN 'Store ' || p_name ELSE p_name END AS name,
          CASE WHEN z % 10 = 0 THEN 'dlc' ELSE 'game' END AS app_type,
          'About ' || p_name AS short_description,
          CASE WHEN z % 6 NOT IN (0, 1) THEN p_brand END AS developer,
          p_type AS publisher,
          CASE WHEN k % 7 <> 0 THEN 'EUR' END AS currency,
          CASE WHEN k % 7 <> 0 THEN (((k * 137) % 6000) * 9 // 10) / 100.0 END AS price_eur,
          CASE WHEN k % 7 <> 0 THEN ((k * 137) % 6000) / 100.0 END AS initial_price_eur,
          CASE WHEN k % 7 <> 0 THEN 10 + v * 5 END AS discount_pct,
          k % 7 = 0 AND k % 21 <> 0 AS is_free,
          '21 Aug, 2012' AS release_date_raw,
          z = 1 AS is_coming_soon,
          z <> 2 AND z % 9 = 0 AS is_early_access,
          z % 2 = 1 AS platform_windows,
          (z // 2) % 2 = 1 AS platform_mac,
          (z // 4) % 2 = 1 AS platform_linux,
          'English<strong>*</strong>' AS supported_languages_raw,
          CASE WHEN z % 2 = 0 THEN 'http://example.com/' || k END AS website
       FROM (SELECT p_partkey AS k, p_size AS z, p_name, p_brand, p_type,
                    unnest(range(0, CASE WHEN p_size > 40 THEN 2 ELSE 1 END)) AS v
             FROM part WHERE p_type <> 'STANDARD')""",
)
_cte(
    "stg_store",
    ["s_rows"],
    """SELECT * FROM s_rows
       QUALIFY row_number() OVER (PARTITION BY app_id ORDER BY _ingested_at DESC NULLS FIRST, load_id DESC) = 1""",
)
_cte(
    "players",
    [],
    """SELECT 'players-' || event_id AS load_id, event_id, event_type, value,
          CASE WHEN event_type = 'error' THEN user_id + 1000000000000 ELSE user_id END AS app_id,
          CAST(floor(value * 100) AS BIGINT) AS current_players,
          ts AS snapshot_at,
          CAST(floor(value * 100) AS BIGINT) + CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END AS player_count_raw,
          ts + INTERVAL 1 MINUTE AS _ingested_at
       FROM events""",
)
_cte(
    "ach_all",
    ["players"],
    """SELECT app_id, snapshot_at, _ingested_at,
          CASE WHEN event_type = 'purchase' AND i = 2 THEN NULL ELSE event_type || '_' || i END AS achievement_name,
          CASE WHEN event_type = 'click' AND i = 1 THEN NULL ELSE (value * ((i + 1) * 7)) % 100 END AS unlock_pct
       FROM (SELECT *, unnest(range(0, CAST(floor(value) AS BIGINT) % 4)) AS i FROM players)""",
)
_cte(
    "stg_achievements",
    ["ach_all"],
    f"""SELECT *, {DIFFICULTY.format(value='unlock_pct')} AS difficulty_label
        FROM ach_all WHERE achievement_name IS NOT NULL""",
)
_cte(
    "games",
    ["stg_details", "stg_store", "players"],
    f"""WITH seen AS (SELECT app_id, max(snapshot_at) AS last_seen FROM players GROUP BY app_id),
             merged AS (
               SELECT base.*, seen.last_seen,
                      coalesce(shop.is_free, base.cents = 0) AS free_flag,
                      list_sum([CAST(coalesce(f, false) AS INTEGER) FOR f IN
                                [shop.platform_windows, shop.platform_mac, shop.platform_linux]]) AS n_platforms,
                      shop AS shop
               FROM stg_details base LEFT JOIN stg_store shop USING (app_id) LEFT JOIN seen USING (app_id))
        SELECT app_id, ifnull(shop.name, name) AS name, ifnull(shop.developer, developer) AS developer,
               ifnull(shop.publisher, publisher) AS publisher,
               shop.app_type, shop.short_description, price_usd, initial_price_usd,
               shop.price_eur, shop.initial_price_eur,
               ifnull(shop.discount_pct, discount_pct) AS discount_pct,
               free_flag AS is_free,
               CASE WHEN free_flag THEN 'free' ELSE {PRICES_IN_CENTS.format(value='cents')} END AS price_tier,
               genres AS genres_details,
               ifnull(shop.platform_windows, false) AS platform_windows,
               ifnull(shop.platform_mac, false) AS platform_mac,
               ifnull(shop.platform_linux, false) AS platform_linux,
               n_platforms > 1 AS is_multi_platform, n_platforms > 0 AS has_any_platform,
               shop.supported_languages_raw, shop.release_date_raw, shop.is_coming_soon,
               owners_range, owners_min, owners_max, positive_reviews, negative_reviews,
               positive_reviews + negative_reviews AS total_reviews, review_score,
               {REVIEWS.format(value='review_score')} AS review_score_label,
               current_players, avg_playtime_forever_min, avg_playtime_2weeks_min,
               median_playtime_forever_min, median_playtime_2weeks_min,
               ifnull(last_seen, (SELECT max(last_seen) FROM seen)) AS snapshot_at,
               _ingested_at, TIMESTAMP '2024-03-01 00:00:00' AS _loaded_at, load_id AS _load_id
        FROM merged""",
)
_cte(
    "trends",
    ["players", "stg_details"],
    f"""WITH numbered AS (
               SELECT app_id, current_players, snapshot_at, _ingested_at,
                      row_number() OVER (PARTITION BY app_id ORDER BY snapshot_at) AS n FROM players),
             paired AS (
               SELECT b.*, a.current_players AS previous_players,
                      (b.current_players - a.current_players) / CAST(nullif(a.current_players, 0) AS DOUBLE) * 100.0 AS pct
               FROM numbered b LEFT JOIN numbered a ON a.app_id = b.app_id AND a.n = b.n - 1)
        SELECT p.app_id, d.name, p.current_players, p.previous_players, p.snapshot_at,
               p.current_players - p.previous_players AS players_delta, p.pct AS players_pct_change,
               {TREND.format(prev='p.previous_players', pct='p.pct')} AS trend_label,
               d.avg_playtime_forever_min, d.avg_playtime_2weeks_min, d.median_playtime_forever_min,
               p._ingested_at, TIMESTAMP '2024-03-01 00:00:00' AS _loaded_at
        FROM paired p LEFT JOIN stg_details d USING (app_id)""",
)
_cte(
    "top_tags",
    ["games", "d_tags"],
    """SELECT g.app_id, array_to_string(list_slice(list(t.tag ORDER BY t.votes DESC, t.tag), 1, 5), ', ') AS top_tags
       FROM games g JOIN d_tags t ON g._load_id = t.load_id GROUP BY g.app_id""",
)
_cte(
    "dim_games",
    ["games", "top_tags"],
    """SELECT md5(CAST(g.app_id AS VARCHAR)) AS game_key, g.app_id, g.name, g.developer, g.publisher,
          coalesce(trim(split_part(g.genres_details, ',', 1)), 'Unknown') AS primary_genre,
          coalesce(g.genres_details, 'Unknown') AS all_genres,
          coalesce(t.top_tags, '') AS top_tags,
          g.platform_windows, g.platform_mac, g.platform_linux, g.is_multi_platform,
          g.is_free, g.is_coming_soon, g.price_tier, g.price_usd, g.release_date_raw,
          g.snapshot_at AS valid_from, CAST(NULL AS TIMESTAMP) AS valid_to, true AS is_current, g._loaded_at
       FROM games g LEFT JOIN top_tags t ON g.app_id = t.app_id""",
)
_cte(
    "dim_genre",
    ["games"],
    """WITH members AS (SELECT DISTINCT trim(unnest(string_split(genres_details, ','))) AS genre_name FROM games)
       SELECT md5(genre_name) AS genre_key, genre_name,
              CASE WHEN genre_name IN ('Action', 'Adventure', 'RPG', 'Strategy', 'Simulation', 'Sports', 'Racing',
                                       'Casual', 'Indie', 'Massively Multiplayer') THEN 'core_genre'
                   WHEN genre_name = 'Free To Play' THEN 'monetization_model'
                   WHEN genre_name = 'Early Access' THEN 'release_state'
                   ELSE 'other' END AS genre_category
       FROM members WHERE length(genre_name) > 0""",
)
_cte(
    "dim_developer",
    ["games"],
    """SELECT md5(developer) AS developer_key, developer AS developer_name,
          max(publisher) AS publisher_name,
          coalesce(bool_or(contains(lower(genres_details), 'indie')), false) AS is_indie,
          count(*) AS total_games,
          round(avg(review_score), 3) AS avg_review_score,
          CAST(sum(current_players) AS BIGINT) AS total_current_players
       FROM games WHERE developer IS NOT NULL GROUP BY developer""",
)
_cte(
    "dim_price_tier",
    [],
    """SELECT CAST(a AS INTEGER) AS price_tier_key, b AS tier_label, CAST(c AS DOUBLE) AS min_price_usd,
          CAST(d AS DOUBLE) AS max_price_usd, CAST(e AS INTEGER) AS display_order
       FROM (VALUES (1, 'free', 0.00, 0.00, 1), (2, 'budget', 0.01, 4.99, 2), (3, 'mid', 5.00, 19.99, 3),
                    (4, 'premium', 20.00, 39.99, 4), (5, 'aaa', 40.00, NULL, 5)) AS t(a, b, c, d, e)""",
)


def calendar_sql(day: str) -> str:
    """Calendar attributes of a DATE column."""
    return f"""CAST(strftime({day}, '%Y%m%d') AS INTEGER) AS date_key, {day} AS full_date,
          CAST(year({day}) AS INTEGER) AS year, CAST(quarter({day}) AS INTEGER) AS quarter,
          year({day}) || '-Q' || quarter({day}) AS quarter_label,
          CAST(month({day}) AS INTEGER) AS month, strftime({day}, '%b') AS month_name,
          left(strftime({day}, '%b'), 3) AS month_short,
          CAST(weekofyear({day}) AS INTEGER) AS week, CAST(day({day}) AS INTEGER) AS day_of_month,
          CAST(dayofweek({day}) + 1 AS INTEGER) AS day_of_week, strftime({day}, '%a') AS day_name,
          dayofweek({day}) IN (0, 6) AS is_weekend, dayofweek({day}) NOT IN (0, 6) AS is_weekday"""


_cte(
    "dim_date",
    [],
    f"""SELECT {calendar_sql('date_day')}
        FROM (SELECT CAST(unnest(generate_series(DATE '2020-01-01', DATE '2030-12-31', INTERVAL 1 DAY)) AS DATE)
              AS date_day)""",
)
_IN_CALENDAR = (
    "CASE WHEN year({ts}) BETWEEN 2020 AND 2030 THEN CAST(strftime({ts}, '%Y%m%d') AS INTEGER) END"
)

# Facts state each key by its formula and need no dimension.
_cte(
    "fct_snapshots",
    ["players", "games"],
    f"""SELECT md5(concat_ws('-', p.app_id, p.snapshot_at)) AS snapshot_key,
               md5(CAST(p.app_id AS VARCHAR)) AS game_key,
               {_IN_CALENDAR.format(ts='p.snapshot_at')} AS date_key,
               md5(ifnull(nullif(trim(split_part(genres_details, ',', 1)), ''), 'Unknown')) AS genre_key,
               md5(ifnull(developer, 'Unknown')) AS developer_key,
               CAST(list_position(['free', 'budget', 'mid', 'premium', 'aaa'], price_tier) AS INTEGER) AS price_tier_key,
               p.current_players, avg_playtime_2weeks_min, median_playtime_forever_min,
               owners_min, owners_max, (owners_min + owners_max) / 2.0 AS owners_midpoint,
               positive_reviews, negative_reviews, total_reviews, review_score, review_score_label,
               price_usd, discount_pct, discount_pct > 0 AS is_on_sale, p.snapshot_at, _loaded_at
        FROM players p JOIN games USING (app_id)""",
)
_cte(
    "fct_achievements",
    ["stg_achievements", "games"],
    f"""WITH known AS (SELECT * FROM stg_achievements SEMI JOIN games USING (app_id))
        SELECT md5(concat_ws('-', app_id, achievement_name, snapshot_at)) AS stat_key,
               md5(CAST(app_id AS VARCHAR)) AS game_key,
               {_IN_CALENDAR.format(ts='snapshot_at')} AS date_key,
               achievement_name, unlock_pct, difficulty_label,
               CAST(rank() OVER easiest_last AS INTEGER) AS difficulty_rank,
               snapshot_at, TIMESTAMP '2024-03-01 00:00:00' AS _loaded_at
        FROM known
        WINDOW easiest_last AS (PARTITION BY app_id, snapshot_at ORDER BY unlock_pct NULLS LAST, achievement_name)""",
)
