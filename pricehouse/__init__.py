"""pricehouse: a market-price warehouse built from Spark DataFrame jobs."""
