"""Whole runs: training, validation, inference."""
