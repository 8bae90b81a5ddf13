"""Forecasting jobs: naive predictors, per-series grouped-map models
(seasonal ARX, decomposable trend + seasonality), global Spark ML boosted
trees, and a direct multi-horizon linear model over sequence windows."""
