"""Risk-network analytics on Spark: integration, graph features, sketches, similarity,
cascade queries, privacy, models and streams, all as DataFrame jobs."""
