"""snapflow: station snapshots to forecasts, as Spark DataFrame operations."""
