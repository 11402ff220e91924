"""Column roles for a table of hospital spells.

A ``RoleConfig`` names which columns are the target, which are dropped, which
are target-encoded, which are scaled and which get a default for missing
values.  Every stage takes one, so the same code runs on the full clinical
schema and on the small ``stays`` fixture built from the driver tables.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from typing import Mapping, Sequence


# ---------------------------------------------------------------------------
# These must equal the reference configuration for the same
# results (column names, drop list, encode list, scale groups, NA defaults).
# ---------------------------------------------------------------------------
TARGET = "spell_episode_los"
CLASS_TARGET = "is_outlier"

DROP_COLS = (
    "site_description", "site_local_code", "specialty_local_code", "specialty_spec_desc",
    "ward_name_admission", "ward_name_discharge", "ward_code_discharge", "ward_type_discharge",
    "date_of_birth_dt", "date_of_death_dt", "discharge_created_datetime_dt",
    "discharge_delay_reason_national_code", "social_worker_date_time_referred",
    "spell_primary_diagnosis_description", "covid19_diagnosis_description", "ID",
    "discharge_letter_sent_in_24hrs", "discharge_letter_status", "discharge_letter_sent",
    "sex_description.y", "spell_dominant_proc_description",
    "Admission_Date", "admission_date_dt", "discharge_date_dt",
    "Arrival_Date", "arrival_date_time", "initial_assessment_date_time",
    "medically_optimised", "patient_age_on_discharge", "IP_discharge",
    "spell_los_hrs", "spell_days_elective", "spell_days_non_elective",
    "delayed_discharges_no_of_days", "delayed_discharges_flag",
    "discharge_delay_reason_description",
)

ENCODE_COLS = (
    "general_medical_practice_desc", "ethnic_origin_description",
    "specialty_spec_code", "specialty_division", "specialty_directorate",
    "hrg_group", "hrg_sub_group", "location", "IP_admission",
    "ward_code_admission", "arrival_mode_description", "source_of_ref_description",
    "place_of_incident", "attendancetype", "presenting_complaint",
    "inj_or_ail", "attend_dis_description", "spell_primary_diagnosis",
    "spell_secondary_diagnosis", "spell_dominant_proc", "ward_type_admission",
    "site_national_code",
)

STD_SCALE_COLS = ("patient_age_on_admission", "Deprivation Decile")
ROBUST_SCALE_COLS = ("duration_elective_wait", "comorbidity_score")

NA_DEFAULTS = {
    "place_of_incident": "Not Specified",
    "ward_code_discharge": "GAST",
    "general_medical_practice_desc": "Unknown",
    "location": "Unknown Location",
    "inj_or_ail": "Not Applicable",
    "attendancetype": "Not Applicable",
    "arrival_mode_description": "Not Applicable",
    "presenting_complaint": "Not Applicable",
    "source_of_ref_description": "Not Applicable",
    "attend_dis_description": "Not Applicable",
    "covid19_diagnosis_flag": 0,
    "NEWS2": -1,
    "duration_elective_wait": -1,
    "ae_unplanned_attendance": 0,
    "acuity_code": -1,
}

FRAILTY_COL = "frailty_score"
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class RoleConfig:
    """Roles of the columns of a spell table.

    ``key`` is a stable row identifier: Spark has no row order, so the key
    carries a spell through splits, joins and predictions.  It is never a
    feature.
    """

    target: str = TARGET
    class_target: str = CLASS_TARGET
    key: str = "ID"
    drop_cols: tuple[str, ...] = DROP_COLS
    encode_cols: tuple[str, ...] = ENCODE_COLS
    std_scale_cols: tuple[str, ...] = STD_SCALE_COLS
    robust_scale_cols: tuple[str, ...] = ROBUST_SCALE_COLS
    na_defaults: Mapping[str, object] = field(default_factory=lambda: dict(NA_DEFAULTS))
    frailty_col: str = FRAILTY_COL
    seed: int = 42
    test_fraction: float = 0.2

    def with_(self, **kw) -> "RoleConfig":
        return replace(self, **kw)

    def drop_list(self) -> tuple[str, ...]:
        """Columns removed at cleaning; the key is kept even if listed."""
        return tuple(c for c in self.drop_cols if c.lower() != self.key.lower())

    def present(self, names: Sequence[str], columns: Sequence[str]) -> list[str]:
        """Names that exist in ``columns`` (Spark resolves case-insensitively),
        returned with the spelling used by the table."""
        lookup = {c.lower(): c for c in columns}
        return [lookup[n.lower()] for n in names if n.lower() in lookup]

    def defaults_for(self, columns: Sequence[str]) -> dict[str, object]:
        """NA defaults restricted to existing columns (``na.fill`` raises on a
        missing name, while the pandas original silently ignores it)."""
        lookup = {c.lower(): c for c in columns}
        return {lookup[k.lower()]: v for k, v in self.na_defaults.items() if k.lower() in lookup}


REFERENCE = RoleConfig()

# The ``stays`` fixture (see sources.fixtures) spells a few columns differently.
STAYS = RoleConfig(
    key="spell_id",
    std_scale_cols=("patient_age_on_admission", "deprivation_decile"),
)
