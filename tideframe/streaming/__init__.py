"""streaming of the market-data engine."""
