"""Whole pipelines: integration, decision, dashboard reads."""
