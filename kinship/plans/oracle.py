"""Independent SQL statements of every registered query, for DuckDB.

They read the driver's parquet tables through the same three views as
``kinship.sources.tables`` and state each result the direct way (for
example the recency task as the literal ``latest - last > 90`` lookup, and
reciprocity as a NOT EXISTS on the reversed edge), so they also check the
rewrites the Spark plans make.
"""

from __future__ import annotations

VIEWS = """
WITH member_page AS (
  SELECT p_partkey AS id, p_name AS nickname, p_type AS job_title,
         p_size AS region_code, p_brand AS fav_hobby
  FROM part
),
follow_edge AS (
  SELECT l_orderkey * 10 + l_linenumber AS rel_id, o_custkey AS id1, l_partkey AS id2,
         l_shipdate AS rel_date, l_returnflag AS rel_desc
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
),
activity_log AS (
  SELECT l_orderkey * 10 + l_linenumber AS action_id, o_custkey AS by_who, l_partkey AS page_id,
         l_linestatus AS action_types, l_shipdate AS action_time
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
),
one_page AS (
  SELECT id, nickname, region_code, job_title FROM member_page WHERE id IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY nickname NULLS LAST, region_code NULLS LAST,
                             job_title NULLS LAST, fav_hobby NULLS LAST) = 1
),
trimmed_page AS (
  SELECT id, nick AS nickname, region_code FROM (
    SELECT id, regexp_replace(nickname, '^[\\x00-\\x20]+|[\\x00-\\x20]+$', '', 'g') AS nick, region_code
    FROM member_page WHERE id IS NOT NULL)
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY nick NULLS LAST, region_code NULLS LAST) = 1
),
same_region AS (
  SELECT DISTINCT f.id1, f.id2, a.nickname AS nick1
  FROM follow_edge f
  JOIN trimmed_page a ON f.id1 = a.id
  JOIN trimmed_page b ON f.id2 = b.id
  WHERE a.region_code = b.region_code
),
one_way AS (
  SELECT e.id1 AS id, e.nick1 AS nickname, e.id2 AS followed_id
  FROM same_region e
  WHERE NOT EXISTS (SELECT 1 FROM same_region r WHERE r.id1 = e.id2 AND r.id2 = e.id1)
),
follower_sets AS (
  SELECT coalesce(p.id, c.id2) AS id, coalesce(p.nickname, '') AS nickname,
         coalesce(c.n, 0) AS n_followers
  FROM one_page p
  FULL OUTER JOIN (SELECT id2, count(DISTINCT id1) AS n FROM follow_edge WHERE id2 IS NOT NULL GROUP BY id2) c
    ON p.id = c.id2
),
received AS (
  SELECT id2 AS id, count(*) AS n_follows FROM follow_edge WHERE id2 IS NOT NULL GROUP BY id2
),
page_access AS (
  SELECT page_id, count(*) AS n_total, count(DISTINCT by_who) AS n_distinct
  FROM activity_log WHERE page_id IS NOT NULL GROUP BY page_id
),
int_log AS (
  SELECT by_who, date_diff('day', DATE '1970-01-01', CAST(action_time AS DATE)) AS t
  FROM activity_log WHERE action_time IS NOT NULL
)
"""

# Fixed value: the hobby picked for the hobby-members query on driver data.
DRIVER_HOBBY = "Brand#7"

_TRIMMED = "regexp_replace(fav_hobby, '^[\\x00-\\x20]+|[\\x00-\\x20]+$', '', 'g')"

_BODIES = {
    "hobby_frequency": f"SELECT {_TRIMMED} AS hobby, count(*) AS frequency FROM member_page WHERE {_TRIMMED} <> '' GROUP BY 1",
    "hobby_frequency_sorted": (
        f"SELECT {_TRIMMED} AS hobby, count(*) AS frequency FROM member_page WHERE {_TRIMMED} <> '' GROUP BY 1 ORDER BY 1"
    ),
    "hobby_members": f"SELECT nickname, job_title FROM member_page WHERE fav_hobby = '{DRIVER_HOBBY}'",
    "page_visits": (
        "SELECT page_id, count(*) AS visits FROM activity_log WHERE page_id IS NOT NULL GROUP BY page_id"
    ),
    "top_pages": """
        SELECT t.page_id, CASE WHEN p.id IS NULL THEN 'Unknown' ELSE p.nickname END AS nickname,
               CASE WHEN p.id IS NULL THEN 'Unknown' ELSE p.job_title END AS job_title, t.visits
        FROM (SELECT page_id, count(*) AS visits FROM activity_log WHERE page_id IS NOT NULL
              GROUP BY page_id ORDER BY visits DESC, page_id ASC LIMIT 10) t
        LEFT JOIN one_page p ON p.id = t.page_id
        ORDER BY t.visits DESC, t.page_id ASC""",
    "follower_count": "SELECT id, nickname, n_followers FROM follower_sets",
    "follower_count_dedup": "SELECT id, nickname, n_followers FROM follower_sets",
    "follower_count_from_text": "SELECT id, nickname, n_followers FROM follower_sets",
    "access_by_page": "SELECT page_id, n_total, n_distinct FROM page_access",
    "access_by_page_from_text": "SELECT page_id, n_total, n_distinct FROM page_access",
    "access_by_person": """
        SELECT by_who, count(*) AS n_total, count(DISTINCT page_id) AS n_distinct
        FROM activity_log WHERE by_who IS NOT NULL GROUP BY by_who""",
    "access_pair_rollup": """
        SELECT page_id, CAST(sum(n) AS BIGINT) AS n_total, count(by_who) AS n_distinct
        FROM (SELECT page_id, by_who, count(*) AS n FROM activity_log WHERE page_id IS NOT NULL
              GROUP BY page_id, by_who) GROUP BY page_id""",
    "access_distinct_first": "SELECT page_id, n_distinct, n_total FROM page_access",
    "access_rendered": (
        "SELECT page_id, CAST(n_total AS VARCHAR) || ',' || CAST(n_distinct AS VARCHAR) AS access FROM page_access"
    ),
    "follows_received": "SELECT id, n_follows FROM received",
    "follower_average": "SELECT CAST(sum(n_follows) AS DOUBLE) / count(*) AS average FROM received",
    "popular_users": """
        SELECT id, n_follows FROM received
        WHERE n_follows > (SELECT CAST(sum(n_follows) AS DOUBLE) / count(*) FROM received)""",
    "popular_users_all_owners": """
        , owners AS (
          SELECT p.id, coalesce(r.n_follows, 0) AS n_follows
          FROM one_page p LEFT JOIN received r ON p.id = r.id)
        SELECT id, n_follows FROM owners
        WHERE n_follows > (SELECT CAST(sum(n_follows) AS DOUBLE) / count(*) FROM owners)""",
    "latest_activity": "SELECT max(action_time) AS latest FROM activity_log",
    "last_seen": """
        SELECT by_who, max(action_time) AS last_seen FROM activity_log
        WHERE action_time IS NOT NULL AND by_who IS NOT NULL GROUP BY by_who""",
    "last_seen_int": """
        SELECT by_who, greatest(max(t), 0) AS last_seen FROM int_log WHERE by_who IS NOT NULL GROUP BY by_who""",
    "outdated_pages": """
        , latest AS (SELECT max(action_time) AS m FROM activity_log),
             last AS (SELECT by_who, max(action_time) AS l FROM activity_log
                      WHERE action_time IS NOT NULL GROUP BY by_who)
        SELECT p.id, p.nickname
        FROM trimmed_page p LEFT JOIN last ON p.id = last.by_who, latest
        WHERE latest.m IS NOT NULL AND (last.l IS NULL OR latest.m - INTERVAL 90 DAYS > last.l)""",
    "outdated_pages_int": """
        , latest AS (SELECT coalesce(max(t), 0) AS m FROM int_log),
             last AS (SELECT by_who, greatest(max(t), 0) AS l FROM int_log GROUP BY by_who)
        SELECT p.id, p.nickname
        FROM trimmed_page p LEFT JOIN last ON p.id = last.by_who, latest
        WHERE latest.m - coalesce(last.l, 0) > 90""",
    "same_region_edges": "SELECT DISTINCT id1, id2 FROM same_region",
    "not_followed_back": "SELECT id, nickname, followed_id FROM one_way",
    "not_followed_back_antijoin": "SELECT id, nickname, followed_id FROM one_way",
    "not_followed_back_people": "SELECT DISTINCT id, nickname FROM one_way",
    "not_followed_back_rendered": """
        SELECT id, nickname || ' follows ID ' || CAST(followed_id AS VARCHAR) || ' (No follow back)' AS report
        FROM one_way""",
    "mutual_degree": """
        SELECT id, CAST(sum(o) AS BIGINT) AS n_following, CAST(sum(i) AS BIGINT) AS n_followers,
               CAST(sum(m) AS BIGINT) AS n_mutual
        FROM (
          SELECT e.id1 AS id, 1 AS o, 0 AS i,
                 CASE WHEN EXISTS (SELECT 1 FROM same_region r WHERE r.id1 = e.id2 AND r.id2 = e.id1)
                      THEN 1 ELSE 0 END AS m
          FROM same_region e
          UNION ALL
          SELECT e.id2 AS id, 0 AS o, 1 AS i, 0 AS m FROM same_region e
        ) GROUP BY id""",
}


def _field(expr: str) -> str:
    """A text field as a CSV writer renders it (quoted when needed)."""
    return (
        f"CASE WHEN {expr} IS NULL THEN '' WHEN {expr} = '' THEN '\"\"' "
        f"WHEN {expr} LIKE '%,%' OR {expr} LIKE '%\"%' THEN '\"' || replace({expr}, '\"', '\"\"') || '\"' "
        f"ELSE {expr} END"
    )


def _num(expr: str) -> str:
    return f"coalesce(CAST({expr} AS VARCHAR), '')"


_LINES = f"""
, mixed_lines AS (
  SELECT 'page' AS source, {_num('id')} || ',' || {_field('nickname')} || ',' || {_field('job_title')}
         || ',' || {_num('region_code')} || ',' || {_field('fav_hobby')} AS line
  FROM member_page
  UNION ALL
  SELECT 'follows', {_num('rel_id')} || ',' || {_num('id1')} || ',' || {_num('id2')} || ','
         || {_num("date_diff('day', DATE '1970-01-01', CAST(rel_date AS DATE))")} || ',' || {_field('rel_desc')}
  FROM follow_edge
  UNION ALL
  SELECT 'activity', {_num('action_id')} || ',' || {_num('by_who')} || ',' || {_num('page_id')} || ','
         || {_field('action_types')} || ',' || coalesce(strftime(CAST(action_time AS DATE), '%Y-%m-%d'), '')
  FROM activity_log
),
line_tokens AS (
  SELECT source, line, list_filter(string_split(line, ','), lambda x: x <> '') AS t, string_split(line, ',') AS f
  FROM mixed_lines
)
"""

# Both source queries split on every comma; exact here because no rendered
# field of the driver tables contains a comma or a quote.
_BODIES["record_type_counts"] = _LINES + """
SELECT kind, count(*) AS n_lines FROM (
  SELECT CASE
    WHEN len(t) < 4 THEN 'malformed'
    WHEN regexp_full_match(t[2], '[0-9]*') AND regexp_full_match(t[3], '[0-9]*')
         AND regexp_full_match(t[4], '[0-9]*') THEN 'follows'
    WHEN regexp_full_match(t[2], '[0-9]*') AND regexp_full_match(t[3], '[0-9]*') THEN 'activity'
    WHEN NOT regexp_full_match(t[2], '[0-9]*') AND NOT regexp_full_match(t[3], '[0-9]*') THEN 'page'
    ELSE 'unknown' END AS kind
  FROM line_tokens) GROUP BY kind"""

_BODIES["malformed_rows"] = _LINES + """
SELECT source, parse, count(*) AS n_lines FROM (
  SELECT source, CASE
    WHEN len(f) <> 5 THEN 'short'
    WHEN try_cast(f[1] AS BIGINT) IS NULL OR try_cast(f[2] AS BIGINT) IS NULL
         OR try_cast(f[3] AS BIGINT) IS NULL OR try_strptime(f[5], '%Y-%m-%d') IS NULL THEN 'bad_field'
    ELSE 'ok' END AS parse
  FROM line_tokens) GROUP BY source, parse"""


# Lines of two fields beside the others: no schema of five fields fits them.
_BODIES["malformed_rows_narrow"] = _BODIES["malformed_rows"].replace(
    "\n),\nline_tokens",
    """
  UNION ALL
  SELECT 'orders', coalesce(CAST(o_orderkey AS VARCHAR), '') || ',' || coalesce(CAST(o_custkey AS VARCHAR), '') FROM orders
),
line_tokens""",
)

# All five kinds: the lines of two fields, and lines of a number, a number, a text and a text.
_BODIES["record_type_counts_all"] = _BODIES["record_type_counts"].replace(
    "\n),\nline_tokens",
    f"""
  UNION ALL
  SELECT 'orders', {_num('o_orderkey')} || ',' || {_num('o_custkey')} FROM orders
  UNION ALL
  SELECT 'customer', {_num('c_custkey')} || ',' || {_num('c_nationkey')} || ',' || {_field('c_name')} || ',' || {_field('c_mktsegment')}
  FROM customer
),
line_tokens""",
)

# Other views of the same tables (see ``sources.tables.VIEWS``): in the first some pages have no follower,
# in the second some followed and visited pages have no record.
REVERSED_VIEWS = VIEWS.replace("o_custkey AS id1, l_partkey AS id2", "l_partkey AS id1, o_custkey AS id2")
CUSTOMER_VIEWS = VIEWS.replace(
    """SELECT p_partkey AS id, p_name AS nickname, p_type AS job_title,
         p_size AS region_code, p_brand AS fav_hobby
  FROM part""",
    """SELECT c_custkey AS id, c_name AS nickname, c_mktsegment AS job_title,
         c_nationkey AS region_code, c_mktsegment AS fav_hobby
  FROM customer""",
)
_ELSEWHERE = {
    "reversed": (REVERSED_VIEWS, ("follower_count", "follower_count_dedup", "popular_users", "popular_users_all_owners")),
    "customers": (CUSTOMER_VIEWS, ("follower_count", "top_pages", "outdated_pages", "not_followed_back")),
}


def statements() -> dict[str, str]:
    found = {name: VIEWS + body for name, body in _BODIES.items()}
    for view, (definitions, names) in _ELSEWHERE.items():
        found |= {f"{name}_{view}": definitions + _BODIES[name] for name in names}
    return found
