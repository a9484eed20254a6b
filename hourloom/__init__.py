"""Hourly forecasting tables on Spark: preparation, lag features, scaling, scoring and checks."""
