"""Whole models, summaries and the daily run, composed of operators."""
