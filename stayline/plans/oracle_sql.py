"""Independent DuckDB SQL for the registered queries.

Each string inlines the ``stays`` derivation (only the driver's base tables
are registered as views) and recomputes the operator from scratch in plain
SQL: quantile_cont for fences and robust scaling, stddev_pop / var_pop for
the scalers and the encoder, md5 for the split.  Doubles are rounded to 6
places on both sides; integers are BIGINT on both sides.
"""

from __future__ import annotations

from ..sources.fixtures import stays_cte

EPS = "1e-9"

# Column groups of the stays fixture (see config.STAYS).
STD_COLS = ("patient_age_on_admission", "deprivation_decile")
ROB_COLS = ("duration_elective_wait", "comorbidity_score")
ENC_COLS = ("arrival_mode_description", "ethnic_origin_description", "specialty_division")
PASS_COLS = ("frailty_score", "news2")


def r6(expr: str) -> str:
    return f"round(CAST({expr} AS DOUBLE), 6)"


def hash_unit(key: str, salt: str) -> str:
    return f"(('0x' || substr(md5('{salt}:' || CAST({key} AS VARCHAR)), 1, 8))::UBIGINT / 4294967296.0)"


def hash_bucket(key: str, salt: str, k: int) -> str:
    return f"CAST((('0x' || substr(md5('{salt}:' || CAST({key} AS VARCHAR)), 1, 8))::UBIGINT % {k}) AS INTEGER)"


CLEAN = """
, dropped AS (SELECT * EXCLUDE (admission_date_dt) FROM stays)
, clean AS (
  SELECT spell_id, spell_episode_los,
    CAST(NULLIF(regexp_extract(CAST(frailty_score AS VARCHAR), '(\\d+)', 1), '') AS DOUBLE) AS frailty_score,
    patient_age_on_admission, deprivation_decile,
    COALESCE(duration_elective_wait, -1) AS duration_elective_wait,
    comorbidity_score,
    COALESCE(news2, -1) AS news2,
    COALESCE(arrival_mode_description, 'Not Applicable') AS arrival_mode_description,
    ethnic_origin_description, specialty_division
  FROM dropped)
, fences AS (
  SELECT quantile_cont(spell_episode_los, 0.25) AS q1, quantile_cont(spell_episode_los, 0.75) AS q3
  FROM clean)
, flagged AS (
  SELECT c.*, COALESCE(c.spell_episode_los > f.q3 + 1.5 * (f.q3 - f.q1)
                    OR c.spell_episode_los < f.q1 - 1.5 * (f.q3 - f.q1), false) AS outl
  FROM clean c CROSS JOIN fences f)
"""


def base(extra: str = "") -> str:
    return stays_cte() + CLEAN + extra


def _families_cte(families: tuple[str, ...]) -> str:
    parts = []
    if "nosplit" in families:
        parts.append("SELECT 'nosplit' AS family, * FROM flagged")
    if "inlier" in families or "outlier" in families:
        fam = ", ".join(f"'{f}'" for f in families if f in ("inlier", "outlier"))
        parts.append("SELECT * FROM (SELECT CASE WHEN outl THEN 'outlier' ELSE 'inlier' END AS family, * "
                     f"FROM flagged) WHERE family IN ({fam})")
    if "class" in families:
        parts.append("SELECT 'class' AS family, * FROM flagged")
    union = "\n  UNION ALL ".join(parts)
    split = hash_unit("spell_id", "42")
    return f"""
, tagged AS (
  {union})
, t2 AS (
  SELECT * EXCLUDE (spell_episode_los, outl),
    CASE WHEN family = 'class' THEN NULL ELSE ln(1 + spell_episode_los) END AS spell_episode_los,
    CASE WHEN family = 'class' THEN CAST(outl AS INTEGER) END AS is_outlier,
    CASE WHEN {split} < 0.2 THEN 'test' ELSE 'train' END AS split
  FROM tagged)
, y AS (
  SELECT *, CASE WHEN family = 'class' THEN CAST(is_outlier AS DOUBLE) ELSE spell_episode_los END AS enc_y
  FROM t2)
, train AS (SELECT * FROM y WHERE split = 'train')
"""


def _scaler_ctes() -> str:
    std_aggs = ", ".join(
        f"avg({c}) AS {c}_c, CASE WHEN stddev_pop({c}) = 0 OR stddev_pop({c}) IS NULL THEN 1.0 "
        f"ELSE stddev_pop({c}) END AS {c}_s" for c in STD_COLS)
    rob_aggs = ", ".join(
        f"quantile_cont({c}, 0.5) AS {c}_c, CASE WHEN quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) = 0 "
        f"OR quantile_cont({c}, 0.25) IS NULL THEN 1.0 "
        f"ELSE quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) END AS {c}_s" for c in ROB_COLS)
    return f"""
, std AS (SELECT family, {std_aggs} FROM train GROUP BY family)
, rob AS (SELECT family, {rob_aggs} FROM train GROUP BY family)
"""


def _encoder_ctes() -> str:
    longs = "\n    UNION ALL ".join(
        f"SELECT family, '{c}' AS col, CAST({c} AS VARCHAR) AS cat, enc_y FROM train WHERE enc_y IS NOT NULL"
        for c in ENC_COLS)
    return f"""
, gstat AS (SELECT family, avg(enc_y) AS m, var_pop(enc_y) AS v FROM train WHERE enc_y IS NOT NULL GROUP BY family)
, longcat AS (
    {longs})
, catstat AS (SELECT family, col, cat, count(*) AS n, avg(enc_y) AS cm, var_pop(enc_y) AS cv
              FROM longcat GROUP BY family, col, cat)
, enc AS (
  SELECT c.family, c.col, c.cat, c.n, c.cm,
    COALESCE(
      (CASE WHEN g.v * c.n + c.cv = 0 THEN NULL ELSE (g.v * c.n) / (g.v * c.n + c.cv) END) * c.cm
      + (1 - (CASE WHEN g.v * c.n + c.cv = 0 THEN NULL ELSE (g.v * c.n) / (g.v * c.n + c.cv) END)) * g.m,
      g.m) AS encoding
  FROM catstat c JOIN gstat g ON c.family = g.family)
"""


def _prepared_cte() -> str:
    std_sel = ", ".join(f"(y.{c} - std.{c}_c) / std.{c}_s AS {c}" for c in STD_COLS)
    rob_sel = ", ".join(f"(y.{c} - rob.{c}_c) / rob.{c}_s AS {c}" for c in ROB_COLS)
    enc_sel = ", ".join(f"COALESCE(e{i}.encoding, gstat.m) AS {c}" for i, c in enumerate(ENC_COLS))
    enc_join = "\n  ".join(
        f"LEFT JOIN (SELECT * FROM enc WHERE col = '{c}') e{i} "
        f"ON e{i}.family = y.family AND e{i}.cat IS NOT DISTINCT FROM CAST(y.{c} AS VARCHAR)"
        for i, c in enumerate(ENC_COLS))
    return f"""
, prepared AS (
  SELECT y.spell_id, y.family, y.split, y.spell_episode_los, y.is_outlier,
    y.frailty_score, y.news2, {std_sel}, {rob_sel}, {enc_sel}
  FROM y
  JOIN std ON std.family = y.family
  JOIN rob ON rob.family = y.family
  JOIN gstat ON gstat.family = y.family
  {enc_join})
"""


def prepared_base(families: tuple[str, ...]) -> str:
    return base(_families_cte(families) + _scaler_ctes() + _encoder_ctes() + _prepared_cte())


FEATURE_COLS = PASS_COLS + STD_COLS + ROB_COLS + ENC_COLS


def prepared_select(label: str, with_family: bool) -> str:
    cols = ["spell_id"] + (["family"] if with_family else []) + ["split", r6(label) + f" AS {label}"
                                                                if label == "spell_episode_los"
                                                                else f"CAST({label} AS INTEGER) AS {label}"]
    cols += [f"{r6(c)} AS {c}" for c in FEATURE_COLS]
    return ", ".join(cols)
