"""Agent-telemetry lakehouse on Spark: bronze, silver and gold data products as DataFrame operators."""
