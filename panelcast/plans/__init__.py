"""Composed jobs: the feature pipeline and the forecasting jobs."""
