"""Pipelines: preprocessing, a full experiment, and its analysis."""
