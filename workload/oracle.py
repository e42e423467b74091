"""SQL for DuckDB over the driver tables, one text per query of ``queries.py``."""

from __future__ import annotations

POINTS = "SELECT l_orderkey, l_linenumber, l_quantity AS x, l_extendedprice / 1e3 AS y FROM lineitem"

RECTANGLES = """
SELECT s_suppkey AS rid,
       CAST(s_suppkey % 45 AS DOUBLE) AS x1, CAST((s_suppkey * 7) % 100 AS DOUBLE) AS y1,
       CAST(s_suppkey % 45 + 5 AS DOUBLE) AS x2, CAST((s_suppkey * 7) % 100 + 10 AS DOUBLE) AS y2
FROM supplier
"""

FLAT_RECTANGLES = """
SELECT s_suppkey AS rid,
       s_suppkey % 45 + CASE WHEN s_suppkey % 10 = 2 THEN 1e-12 ELSE 0e0 END AS x1,
       CAST((s_suppkey * 7) % 100 AS DOUBLE) AS y1,
       s_suppkey % 45 + CASE WHEN s_suppkey % 10 = 0 OR s_suppkey = 5 THEN 0e0 ELSE 5e0 END AS x2,
       (s_suppkey * 7) % 100 + CASE WHEN s_suppkey % 10 = 1 OR s_suppkey = 5 THEN 0e0 ELSE 10e0 END AS y2
FROM supplier
"""

POINT_TEXT = """
CAST(CAST(l_quantity AS INT) AS VARCHAR) || ',' || CAST(CAST(l_extendedprice / 1e3 AS DECIMAL(10,5)) AS VARCHAR)
"""

TRIP_LON = "CAST(CAST(-74.52e0 + 1e-2 * l_quantity + 5e-3 AS DECIMAL(8,3)) AS VARCHAR)"
TRIP_LAT = "CAST(CAST(40.48e0 + 1e-2 * (l_suppkey % 45) + 5e-3 AS DECIMAL(8,3)) AS VARCHAR)"
TRIP_TEXTS = f"SELECT l_shipdate AS time, {TRIP_LON} AS lon, {TRIP_LAT} AS lat FROM lineitem"


def _degrees(hundredths: str) -> str:
    return f"CAST(CAST(CAST({hundredths} AS DOUBLE) / 1e2 AS DECIMAL(8,2)) AS VARCHAR)"


ZONES = f"""
SELECT {_degrees("-7450 + s_suppkey % 40")} AS x1, {_degrees("4050 + (s_suppkey * 7) % 40")} AS y1,
       {_degrees("-7447 + s_suppkey % 40")} AS x2, {_degrees("4054 + (s_suppkey * 7) % 40")} AS y2
FROM supplier
"""
ZONE_TEXT = "concat_ws(',', x1, y1, x2, y2)"

ZONE_PAIRS = f"""
SELECT {ZONE_TEXT} AS rectangle, t.lon || ',' || t.lat AS point
FROM ({ZONES}) z JOIN ({TRIP_TEXTS}) t
  ON CAST(t.lon AS DOUBLE) BETWEEN CAST(z.x1 AS DOUBLE) AND CAST(z.x2 AS DOUBLE)
 AND CAST(t.lat AS DOUBLE) BETWEEN CAST(z.y1 AS DOUBLE) AND CAST(z.y2 AS DOUBLE)
"""

RANGE_SELECT = f"SELECT * FROM ({POINTS}) WHERE x BETWEEN 1e1 AND 3e1 AND y BETWEEN 2e1 AND 6e1"

DISTANCE_SELECT = f"""
SELECT * FROM ({POINTS})
WHERE sqrt((25e0 - x) * (25e0 - x) + (45e0 - y) * (45e0 - y)) <= 1e1
"""


def _area(x1, y1, x2, y2, x3, y3) -> str:
    return f"abs(({x1} * ({y2} - {y3}) + {x2} * ({y3} - {y1}) + {x3} * ({y1} - {y2})) / 2e0)"


def _area_test(x1, y1, x2, y2) -> str:
    rectangle = f"({_area(x1, y2, x2, y2, x2, y1)} + {_area(x1, y2, x1, y1, x2, y1)})"
    fan = " + ".join(
        _area("x", "y", *side)
        for side in ((x1, y2, x2, y2), (x2, y2, x2, y1), (x2, y1, x1, y1), (x1, y1, x1, y2))
    )
    return f"({fan}) - {rectangle} <= 1e-10"


def _range_join(test: str, rectangles: str = RECTANGLES) -> str:
    return f"SELECT rid, l_orderkey, l_linenumber, x, y FROM ({rectangles}) r JOIN ({POINTS}) p ON {test}"


RANGE_JOIN = _range_join("x BETWEEN x1 AND x2 AND y BETWEEN y1 AND y2")

DISTANCE_JOIN = """
SELECT id1, x1, y1, id2, x2, y2
FROM (SELECT c_custkey AS id1, c_acctbal / 1e2 AS x1, CAST(c_nationkey AS DOUBLE) AS y1 FROM customer) a
JOIN (SELECT s_suppkey AS id2, s_acctbal / 1e2 AS x2, CAST(s_nationkey AS DOUBLE) AS y2 FROM supplier) b
  ON sqrt((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1)) <= 2e0
"""


def _cells(day: str) -> str:
    return f"""
SELECT CAST(floor((-74.52e0 + 1e-2 * l_quantity + 5e-3) / 1e-2) AS INT) AS x,
       CAST(floor((40.48e0 + 1e-2 * (l_suppkey % 45) + 5e-3) / 1e-2) AS INT) AS y,
       CAST({day}(l_shipdate) AS INT) AS z
FROM lineitem
"""


BOUNDED = f"""
SELECT x, y, z FROM ({_cells("day")})
WHERE x BETWEEN -7450 AND -7370 AND y BETWEEN 4050 AND 4090 AND z BETWEEN 1 AND 31
"""

COUNTS = f"SELECT x, y, z, count(*) AS n FROM ({BOUNDED}) GROUP BY x, y, z"

STATS = f"""
SELECT total, sum_sq, mean, sqrt(sum_sq / 102951e0 - mean * mean) AS std
FROM (SELECT total, sum_sq, total / 102951e0 AS mean
      FROM (SELECT CAST(sum(n) AS BIGINT) AS total, CAST(sum(n * n) AS BIGINT) AS sum_sq FROM ({COUNTS})))
"""

NEIGHBOR_SUMS = f"""
SELECT t1.x, t1.y, t1.z, t1.n, CAST(sum(t2.n) AS BIGINT) AS neighbor_sum
FROM ({COUNTS}) t1
CROSS JOIN (SELECT unnest([-1, 0, 1]) AS dx) ox
CROSS JOIN (SELECT unnest([-1, 0, 1]) AS dy) oy
CROSS JOIN (SELECT unnest([-1, 0, 1]) AS dz) oz
JOIN ({COUNTS}) t2 ON t2.x = t1.x + dx AND t2.y = t1.y + dy AND t2.z = t1.z + dz
GROUP BY t1.x, t1.y, t1.z, t1.n
"""

EXACT_FACES = """
CAST(x IN (-7450, -7370) AS INT) + CAST(y IN (4050, 4090) AS INT) + CAST(z IN (1, 31) AS INT)
"""
COMPAT_FACES = """
CAST(x IN (-7450, 4050) AS INT) + CAST(y IN (1, -7370) AS INT) + CAST(z IN (4090, 31) AS INT)
"""


def _scores(faces: str) -> str:
    return f"""
SELECT x, y, z, n, neighbor_sum, neighbors,
       (neighbor_sum - mean * neighbors)
         / (std * sqrt((102951e0 * neighbors - CAST(neighbors AS DOUBLE) * neighbors) / 102950e0)) AS z_score
FROM (SELECT *, CASE {faces} WHEN 0 THEN 27 WHEN 1 THEN 18 WHEN 2 THEN 12 ELSE 8 END AS neighbors
      FROM ({NEIGHBOR_SUMS})) s
CROSS JOIN ({STATS}) stats
"""


def _rounded(scores: str) -> str:
    return f"SELECT x, y, z, n, neighbor_sum, neighbors, round(z_score, 6) AS z_score FROM ({scores})"


RANKED = f"SELECT x, y, z FROM ({_scores(EXACT_FACES)}) ORDER BY z_score DESC, x DESC, y ASC, z DESC"

RATINGS = "SELECT l_suppkey AS userid, l_partkey AS movieid, l_quantity / 1e1 AS rating FROM lineitem"
RATING_BATCH = "SELECT o_custkey AS userid, o_orderkey AS movieid, o_totalprice / 9e4 AS rating FROM orders"
ORDERED = "SELECT o_custkey AS userid, o_orderkey AS movieid, o_totalprice / 1e5 AS rating FROM orders"
ORDERED_BATCH = "SELECT user_id AS userid, event_id AS movieid, value / 1e2 AS rating FROM events"

RANGES = """
SELECT CAST(i AS INT) AS part, 5e0 * i / 10e0 AS low, 5e0 * (i + 1) / 10e0 AS high FROM range(10) t(i)
"""


def _range_parts(ratings: str) -> str:
    return f"""
SELECT userid, movieid, rating, part AS part_id
FROM ({ratings}) r
LEFT JOIN ({RANGES}) b ON rating <= high AND (rating > low OR (part = 0 AND rating >= low))
"""


RANGE_SIZES = f"""
SELECT part, count(userid) AS n
FROM ({RANGES}) LEFT JOIN ({_range_parts(RATINGS)}) ON part = part_id GROUP BY part
"""

ROBIN = f"""
SELECT userid, movieid, rating, CAST((row_number() OVER (ORDER BY movieid) - 1) % 7 AS INT) AS part_id
FROM ({ORDERED})
"""

ROBIN_BATCH = f"""
SELECT userid, movieid, rating,
       CAST(((SELECT count(*) FROM orders) + row_number() OVER (ORDER BY movieid) - 1) % 7 AS INT) AS part_id
FROM ({ORDERED_BATCH})
"""


def _nulls(table: str, subject: str, column: str, source: str) -> str:
    return f"SELECT '{table}', 'not null', '{subject}', count(*) FROM {source} WHERE {column} IS NULL"


def _duplicates(table: str, subject: str, columns: str, source: str) -> str:
    return f"""SELECT '{table}', 'unique', '{subject}', CAST(coalesce(sum(n), 0) AS BIGINT)
FROM (SELECT count(*) AS n FROM {source} GROUP BY {columns} HAVING count(*) > 1)"""


def _orphans(table: str, subject: str, column: str, source: str, parent: str, key: str) -> str:
    return f"""SELECT '{table}', 'foreign key', '{subject}', count(*)
FROM {source} WHERE {column} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {parent} WHERE {key} = {column})"""


TAG_ID = "CAST(floor(value / 1e1) AS BIGINT)"

SCHEMA_REPORT = "\nUNION ALL\n".join(
    [
        "SELECT 'users' AS table_name, 'not null' AS rule, 'userid' AS subject, count(*) AS violations"
        " FROM customer WHERE c_custkey IS NULL",
        _nulls("users", "name", "c_name", "customer"),
        _nulls("movies", "movieid", "p_partkey", "part"),
        _nulls("movies", "title", "p_name", "part"),
        _nulls("taginfo", "tagid", "n_nationkey", "nation"),
        _nulls("taginfo", "content", "n_name", "nation"),
        _nulls("genres", "genreid", "r_regionkey", "region"),
        _nulls("genres", "name", "r_name", "region"),
        _nulls("ratings", "userid", "l_suppkey", "lineitem"),
        _nulls("ratings", "movieid", "l_partkey", "lineitem"),
        _nulls("ratings", "rating", "l_quantity", "lineitem"),
        _nulls("ratings", "timestamp", "l_shipdate", "lineitem"),
        _nulls("tags", "userid", "user_id", "events"),
        _nulls("tags", "movieid", "event_id", "events"),
        _nulls("tags", "tagid", "value", "events"),
        _nulls("hasagenre", "movieid", "p_partkey", "part"),
        _nulls("hasagenre", "genreid", "p_size", "part"),
        _duplicates("users", "userid", "c_custkey", "customer"),
        _duplicates("movies", "movieid", "p_partkey", "part"),
        _duplicates("taginfo", "tagid", "n_nationkey", "nation"),
        _duplicates("genres", "genreid", "r_regionkey", "region"),
        _duplicates("ratings", "userid, movieid, rating", "l_suppkey, l_partkey, l_quantity", "lineitem"),
        _duplicates("hasagenre", "movieid, genreid", "p_partkey, p_size", "part"),
        _orphans("ratings", "userid -> users.userid", "l_suppkey", "lineitem", "customer", "c_custkey"),
        _orphans("ratings", "movieid -> movies.movieid", "l_partkey", "lineitem", "part", "p_partkey"),
        _orphans("tags", "userid -> users.userid", "user_id", "events", "customer", "c_custkey"),
        _orphans("tags", "movieid -> movies.movieid", "event_id", "events", "part", "p_partkey"),
        _orphans("tags", "tagid -> taginfo.tagid", TAG_ID, "events", "nation", "n_nationkey"),
        _orphans("hasagenre", "movieid -> movies.movieid", "pp.p_partkey", "part pp", "part", "part.p_partkey"),
        _orphans("hasagenre", "genreid -> genres.genreid", "p_size", "part", "region", "r_regionkey"),
        "SELECT 'ratings', 'check', 'rating >= 0 AND rating <= 5', count(*) FROM lineitem"
        " WHERE NOT (l_quantity / 9e0 >= 0 AND l_quantity / 9e0 <= 5)",
    ]
)

LABELED = "(SELECT d.*, quality, toxic FROM documents d LEFT JOIN labels USING (doc_id))"


def _null_count(column: str) -> str:
    return f"SELECT '{column}' AS column_name, count(*) AS nulls FROM {LABELED} WHERE {column} IS NULL"


ORACLE = {
    "src_points": f"""
SELECT point, CAST(split_part(point, ',', 1) AS DOUBLE) AS x, CAST(split_part(point, ',', 2) AS DOUBLE) AS y
FROM (SELECT {POINT_TEXT} AS point FROM lineitem)""",
    "src_rects": f"""
SELECT {ZONE_TEXT} AS rectangle, CAST(x1 AS DOUBLE) AS x1, CAST(y1 AS DOUBLE) AS y1,
       CAST(x2 AS DOUBLE) AS x2, CAST(y2 AS DOUBLE) AS y2
FROM ({ZONES})""",
    "src_trips": f"""
SELECT strftime(time, '%Y-%m-%d %H:%M:%S') AS time, CAST(lon AS DOUBLE) AS lon, CAST(lat AS DOUBLE) AS lat
FROM ({TRIP_TEXTS})""",
    "src_pickups": f"""
SELECT lon || ',' || lat AS point, CAST(lon AS DOUBLE) AS lon, CAST(lat AS DOUBLE) AS lat
FROM ({TRIP_TEXTS})""",
    "src_rejects": """
SELECT 'points' AS source, count(*) AS total, count(*) FILTER (l_linenumber IN (5, 6, 7)) AS rejected FROM lineitem
UNION ALL SELECT 'rectangles', count(*), count(*) FILTER (s_suppkey % 7 = 0) FROM supplier
UNION ALL SELECT 'trips', count(*), count(*) FILTER (l_linenumber IN (6, 7)) FROM lineitem
UNION ALL SELECT 'ratings', count(*), count(*) FILTER (l_linenumber IN (6, 7)) FROM lineitem""",
    "load_ratings": """
SELECT CAST(l_suppkey AS INT) AS userid, CAST(l_partkey AS INT) AS movieid,
       CAST(round(l_discount * 100) / 2 AS REAL) AS rating
FROM lineitem""",
    "sink_csv": f"""
SELECT CAST(x AS VARCHAR) AS a, CAST(y AS VARCHAR) AS b, CAST(z AS VARCHAR) AS c, 0 AS result
FROM ({RANKED} LIMIT 50)
UNION ALL SELECT rectangle, point, NULL, 1 FROM ({ZONE_PAIRS})""",
    "geo_range_select": RANGE_SELECT,
    "geo_range_select_clustered": RANGE_SELECT,
    "geo_distance_select_clustered": DISTANCE_SELECT,
    "geo_range_select_compat": f"SELECT * FROM ({POINTS}) WHERE {_area_test('1e1', '2e1', '1e1', '6e1')}",
    "geo_distance_select": DISTANCE_SELECT,
    "geo_range_join": RANGE_JOIN,
    "geo_range_join_shuffle": RANGE_JOIN,
    "geo_range_join_compat": _range_join(_area_test("x1", "y1", "x2", "y2"), FLAT_RECTANGLES),
    "geo_distance_join": DISTANCE_JOIN,
    "geo_distance_join_shuffle": DISTANCE_JOIN,
    "geo_range_select_count": f"SELECT count(*) AS n FROM ({RANGE_SELECT})",
    "geo_distance_select_count": f"SELECT count(*) AS n FROM ({DISTANCE_SELECT})",
    "geo_range_join_count": f"SELECT count(*) AS n FROM ({RANGE_JOIN})",
    "geo_range_join_count_shuffle": f"SELECT count(*) AS n FROM ({RANGE_JOIN})",
    "geo_distance_join_count_shuffle": f"SELECT count(*) AS n FROM ({DISTANCE_JOIN})",
    "geo_distance_join_count": f"SELECT count(*) AS n FROM ({DISTANCE_JOIN})",
    "hot_zone_pairs": ZONE_PAIRS,
    "cell_assign": _cells("day"),
    "cell_assign_doy": _cells("dayofyear"),
    "cell_bounded": BOUNDED,
    "cell_counts": COUNTS,
    "cell_stats": f"SELECT total, sum_sq, round(mean, 9) AS mean, round(std, 9) AS std FROM ({STATS})",
    "cell_neighbor_sums": NEIGHBOR_SUMS,
    "getis_ord_scores": _rounded(_scores(EXACT_FACES)),
    "getis_ord_scores_compat": _rounded(_scores(COMPAT_FACES)),
    "hot_cells_ranked": RANKED,
    "hot_cells_top50": f"{RANKED} LIMIT 50",
    "range_partition": _range_parts(RATINGS),
    "range_partition_sizes": f"SELECT part AS part_id, n FROM ({RANGE_SIZES})",
    "range_partition_bounds": f"""
SELECT part AS partition_num, low AS min_rating, high AS max_rating, n
FROM ({RANGE_SIZES}) JOIN ({RANGES}) USING (part)""",
    "range_append": f"{_range_parts(RATINGS)} UNION ALL {_range_parts(RATING_BATCH)}",
    "range_append_repeated": f"{_range_parts(RATINGS)} UNION ALL {_range_parts(RATING_BATCH)} UNION ALL {_range_parts(RATING_BATCH)}",
    "rr_partition": ROBIN,
    "rr_partition_sizes": f"SELECT part_id, count(*) AS n FROM ({ROBIN}) GROUP BY part_id",
    "rr_state": "SELECT 7 AS partition_num, CAST(count(*) % 7 AS INT) AS table_next_insert FROM orders",
    "rr_append": f"{ROBIN} UNION ALL {ROBIN_BATCH}",
    "rr_append_repeated": f"""
SELECT part_id, n, 7 AS partition_num, CAST((SELECT count(*) FROM ({ROBIN} UNION ALL {ROBIN_BATCH})) % 7 AS INT) AS table_next_insert
FROM (SELECT part_id, count(*) AS n FROM ({ROBIN} UNION ALL {ROBIN_BATCH}) GROUP BY part_id)""",
    "dq_not_null": " UNION ALL ".join(
        _null_count(c) for c in ("doc_id", "text", "lang", "source", "n_chars", "quality", "toxic")
    ),
    "dq_unique": """
SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
    "dq_foreign_key": """
SELECT o_custkey, count(*) AS n FROM orders
WHERE o_custkey NOT IN (SELECT s_suppkey FROM supplier) GROUP BY o_custkey""",
    "dq_check": "SELECT c_custkey, c_acctbal FROM customer WHERE NOT (c_acctbal BETWEEN 0 AND 5000)",
    "dq_schema_report": SCHEMA_REPORT,
}
