"""functions of the market-data engine."""
