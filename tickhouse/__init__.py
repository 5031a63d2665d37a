"""tickhouse: market-bar ingest, pipeline health, cost and table reports as Spark jobs."""
