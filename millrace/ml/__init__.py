"""Fitted preprocessing, selection, resampling, splits, models and metrics."""
