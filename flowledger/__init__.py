"""Workflow-operations analytics on Spark: validate, stage, load and report workflow events."""
