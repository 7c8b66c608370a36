"""Ledger-lake analytics on Spark: typed raw tables, versioned tables, gates, replicas and checks."""
