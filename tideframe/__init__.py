"""Market-data lakehouse analytics on Spark."""
