"""Runnable jobs: ``python -m cohortlens.jobs.<name>`` or ``spark-submit``."""
