"""Hospital staffing and patient-flow analytics as plain Spark DataFrame jobs."""
