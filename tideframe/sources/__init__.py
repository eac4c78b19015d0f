"""sources of the market-data engine."""
