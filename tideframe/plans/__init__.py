"""plans of the market-data engine."""
