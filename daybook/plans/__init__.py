"""Composed plans: run days, rollups and the daily pipeline."""
