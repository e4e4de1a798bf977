"""Daily point-in-time market data on Spark: sources, rules, upserts, audits and streams."""
