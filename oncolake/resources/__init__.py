"""One module per group of mapping jobs: exploded reports in, typed resource tables out."""

from oncolake.resources.conditions import map_conditions, map_earlier_tumours, map_evidence_lists
from oncolake.resources.diagnosis import (
    map_classifications,
    map_genetic_variants,
    map_metastases,
    map_performance_status,
    map_study_participation,
)
from oncolake.resources.histology import (
    map_course_histology,
    map_grading,
    map_lymph_nodes,
    map_pathology_reports,
    map_specimens,
)
from oncolake.resources.outcomes import (
    map_deaths,
    map_progress,
    map_status_deaths,
    map_tumour_boards,
    map_vital_status,
)
from oncolake.resources.patients import map_patients
from oncolake.resources.prostate import map_gleason, map_prostate_module
from oncolake.resources.therapies import (
    map_adverse_events,
    map_medication_statements,
    map_medications,
    map_radiotherapy,
    map_residual_status,
    map_surgeries,
    map_systemic_procedures,
)
from oncolake.resources.tnm import map_tnm

__all__ = [name for name in dir() if name.startswith("map_")]
