"""The functions notebooks call, under one import."""

from wardflow.functions.staffing import build_dq_flags_column, cast_silver_types, parse_work_date
from wardflow.operators.control import (
    complete_pipeline_run,
    register_file,
    start_pipeline_run,
    update_file_layer_status,
    write_dq_results,
    write_job_bookmark,
    write_pipeline_log,
    write_schema_registry,
)
from wardflow.operators.dedup import get_watermark
from wardflow.sources.landing import DEFAULT_SCHEMA_HINTS, get_schema_hints

__all__ = [
    "DEFAULT_SCHEMA_HINTS",
    "build_dq_flags_column",
    "cast_silver_types",
    "complete_pipeline_run",
    "get_schema_hints",
    "get_watermark",
    "parse_work_date",
    "register_file",
    "start_pipeline_run",
    "update_file_layer_status",
    "write_dq_results",
    "write_job_bookmark",
    "write_pipeline_log",
    "write_schema_registry",
]
