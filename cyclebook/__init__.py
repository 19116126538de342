"""Volume-weighted trade indices on Spark: ingest, classify, place in cycles, analyze."""
