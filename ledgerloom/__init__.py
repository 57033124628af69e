"""Retail reporting on Spark: text exports to a star schema, KPI marts and safe exports."""
