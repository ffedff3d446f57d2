"""DuckDB SQL for the derived views, used by the oracle queries.

These are written independently of the Spark code (plain SQL, window
functions instead of the Spark-side rank helpers), so a match between the two
is a real check. Every oracle query starts with `WITH <views for a dataset>`.
"""

from __future__ import annotations


def rnd(expr: str, scale: int) -> str:
    """SQL's ROUND of an exact number: half away from zero, once, at `scale` places."""
    return f"CAST(ROUND(CAST({expr} AS DECIMAL(38,15)), {scale}) AS DOUBLE)"


def mr(expr: str) -> str:
    """A metric at 12 decimals."""
    return f"CAST(ROUND(CAST({expr} AS DECIMAL(38,18)), 12) AS DOUBLE)"


def wr(v: str, r: str, m: int, c: str) -> str:
    """Bayesian weighted rating in double precision."""
    vd = f"CAST({v} AS DOUBLE)"
    return f"(({vd} / ({vd} + {float(m)!r})) * {r} + ({float(m)!r} / ({vd} + {float(m)!r})) * {c})"


_COMMON = r"""
users AS (
  SELECT c_custkey AS user_id,
         CASE WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS gender,
         CAST([1, 18, 25, 35, 45, 50, 56][CAST(c_custkey % 7 AS INTEGER) + 1] AS INTEGER) AS age,
         CAST(c_nationkey % 21 AS INTEGER) AS occupation,
         CASE WHEN c_custkey < 100000 THEN lpad(CAST(c_custkey AS VARCHAR), 5, '0')
              ELSE CAST(c_custkey AS VARCHAR) END AS zip_code
  FROM customer),
items_raw AS (
  SELECT p_partkey AS item_id,
         CASE WHEN p_partkey % 50 = 0 THEN p_name
              ELSE p_name || ' (' || CAST(1950 + p_size AS VARCHAR) || ')' END AS title,
         CASE WHEN p_partkey % 97 <> 0 THEN replace(p_name, ' ', '|') || '|' || p_type END AS genres
  FROM part),
items_stripped AS (
  SELECT item_id, regexp_replace(title, '^\s+|\s+$', '', 'g') AS t FROM items_raw),
items AS (
  SELECT item_id,
         regexp_replace(t, '\s*\(\d{4}\)$', '') AS title,
         CASE WHEN regexp_extract(t, '\((\d{4})\)$', 1) <> ''
              THEN CAST(regexp_extract(t, '\((\d{4})\)$', 1) AS INTEGER) END AS release_year
  FROM items_stripped),
genre_tokens AS (
  SELECT item_id, unnest(string_split(genres, '|')) AS genre_name
  FROM items_raw WHERE genres IS NOT NULL),
genres AS (
  SELECT CAST(row_number() OVER (ORDER BY genre_name) AS INTEGER) AS genre_id, genre_name
  FROM (SELECT DISTINCT genre_name FROM genre_tokens)),
item_genres AS (
  SELECT t.item_id, g.genre_id FROM genre_tokens t JOIN genres g ON t.genre_name = g.genre_name),
genre_strings AS (
  SELECT ig.item_id, string_agg(DISTINCT g.genre_name, '|' ORDER BY g.genre_name) AS genres
  FROM item_genres ig JOIN genres g ON ig.genre_id = g.genre_id GROUP BY ig.item_id)"""

_R1 = r"""
ratings_dedup AS (
  SELECT user_id, item_id, rating, ts FROM (
    SELECT o.o_custkey AS user_id, l.l_partkey AS item_id,
           CAST(ceil(l.l_quantity / 5) * 0.5 AS DOUBLE) AS rating, o.o_orderdate AS ts,
           row_number() OVER (PARTITION BY o.o_custkey, l.l_partkey
                              ORDER BY o.o_orderdate DESC, l.l_orderkey DESC,
                                       l.l_linenumber DESC, l.l_quantity DESC) AS rn
    FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)
  WHERE rn = 1)"""

_R2 = r"""
ratings_dedup AS (
  SELECT user_id, item_id, rating, ts FROM (
    SELECT user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS item_id,
           CAST(0.5 * least(10, 1 + floor(value / 8)) AS DOUBLE) AS rating, ts,
           row_number() OVER (PARTITION BY user_id, CAST(json_extract_string(props, '$.k') AS BIGINT)
                              ORDER BY ts DESC, event_id DESC) AS rn
    FROM events)
  WHERE rn = 1)"""

_SPLIT = r"""
ratings AS (
  SELECT user_id * 1000000000 + item_id AS rating_id, user_id, item_id, rating, ts
  FROM ratings_dedup WHERE rating BETWEEN 0.5 AND 5.0),
labelled AS (
  SELECT rating_id, user_id, item_id, rating, ts,
         rn <= greatest(1, CAST(floor(n * 0.2) AS BIGINT)) AS is_test
  FROM (SELECT r.*,
               row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, rating_id DESC) AS rn,
               count(*) OVER (PARTITION BY user_id) AS n
        FROM ratings r)
  WHERE n >= 5),
train AS (SELECT rating_id, user_id, item_id, rating, ts FROM labelled WHERE NOT is_test),
test AS (SELECT rating_id, user_id, item_id, rating, ts FROM labelled WHERE is_test)"""

_DATASETS = {"r1": _R1, "r2": _R2}


def with_views(dataset: str | None, select: str, ctes: str = "") -> str:
    """`WITH <common views>[, <dataset ratings/train/test>][, ctes] select`."""
    parts = [_COMMON.strip()]
    if dataset:
        parts += [_DATASETS[dataset].strip(), _SPLIT.strip()]
    if ctes.strip():
        parts.append(ctes.strip().rstrip(","))
    return "WITH " + ",\n".join(parts) + "\n" + select.strip()
