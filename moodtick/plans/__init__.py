"""Composed plans: the pipeline and the dashboard."""
