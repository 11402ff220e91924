"""The ``stays`` table: a spell table derived from the driver tables.

The real input (a wide CSV of hospital spells) is not public, so every query
runs on a spell-shaped table that Spark derives from ``events``, ``customer``
and ``nation``.  Its work grows with those tables.  The same SQL text is used
as the DuckDB oracle's inline CTE, so both engines see identical rows.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

# Fixed text: the spell derivation shared with the DuckDB oracle.
STAYS_SQL = """
WITH e AS (
  SELECT event_id, ts, user_id, event_type, value,
         CAST(regexp_extract(props, '([0-9]+)', 1) AS int) AS k
  FROM {events})
SELECT e.event_id AS spell_id,
  e.ts AS admission_date_dt,
  CAST(floor(e.value / 10) AS double) AS spell_episode_los,
  CASE WHEN k % 7 = 0 THEN NULL
       ELSE concat(CAST(k % 10 AS string), ' - level') END AS frailty_score,
  CASE WHEN k % 11 = 0 THEN NULL
       ELSE CAST(k AS double) END AS patient_age_on_admission,
  CAST(1 + k % 10 AS double) AS deprivation_decile,
  CASE WHEN e.event_type = 'signup'
       THEN CAST(k * 2 AS double) END AS duration_elective_wait,
  CAST(e.user_id % 30 AS double) AS comorbidity_score,
  CASE WHEN k % 3 = 0 THEN NULL ELSE CAST(k % 15 AS double) END AS news2,
  CASE WHEN e.event_type = 'error' THEN NULL
       ELSE e.event_type END AS arrival_mode_description,
  CASE WHEN k % 5 = 0 THEN NULL ELSE n.n_name END AS ethnic_origin_description,
  c.c_mktsegment AS specialty_division
FROM e
JOIN {customer} c ON e.user_id = c.c_custkey
JOIN {nation} n ON c.c_nationkey = n.n_nationkey
"""

DRIVER_TABLES = ("events", "customer", "nation")


def driver_tables(spark: SparkSession, sf_dir: str,
                  names: tuple[str, ...] = DRIVER_TABLES) -> dict[str, DataFrame]:
    """Driver parquet tables as DataFrames (lazy; nothing is read)."""
    return {name: spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet")) for name in names}


def stays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw spell table (before cleaning).  The tables are passed to
    ``spark.sql`` as DataFrame arguments -- no session-wide views.
    ``customer`` and ``nation`` are dimension tables; Catalyst broadcasts
    them when their scanned size is under the broadcast threshold and
    sort-merge joins otherwise."""
    return spark.sql(STAYS_SQL, **driver_tables(spark, sf_dir))


def stays_cte() -> str:
    """``WITH stays AS (...)`` prefix for oracle SQL (plain table names)."""
    body = STAYS_SQL.strip().format(**{n: n for n in DRIVER_TABLES})
    return f"WITH stays AS (\n{body}\n)\n"
