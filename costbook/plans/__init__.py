"""End-to-end pipelines and the registry of queries checked against SQL oracles."""
