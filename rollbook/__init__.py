"""rollbook: a harvest-and-liveness ledger for listed endpoints, on Spark."""
