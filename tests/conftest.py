import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from wardflow.config import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "wardflow-tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


STAFFING = "facility_id,work_date,role_code,staff_count,patient_census,hours_worked,hours_worked_overtime,shift_type"


@pytest.fixture
def staffing_frame(spark):
    """Bronze-like frame from rows of the eight staffing columns."""

    def build(*rows, ingested="2026-01-01 00:00:00"):
        ddl = ", ".join(f"{c} STRING" for c in STAFFING.split(","))
        from pyspark.sql import functions as F

        df = spark.createDataFrame([tuple(r) for r in rows], ddl)
        return df.select(
            "*",
            F.lit("landing/FAC/a.csv").alias("_source_file"),
            F.lit(ingested).cast("timestamp").alias("_ingested_at"),
            F.sha2(F.concat_ws("|", *df.columns), 256).alias("_record_index"),
        )

    return build
