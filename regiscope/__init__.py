"""Registry analytics on Spark: load, clean, publish and query company-registry snapshots."""
