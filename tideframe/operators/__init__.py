"""operators of the market-data engine."""
