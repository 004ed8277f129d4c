"""Spark operators that turn landed API pages into typed, date-partitioned tables, and plan incremental work."""
