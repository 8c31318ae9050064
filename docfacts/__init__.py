"""Document facts on Spark."""
