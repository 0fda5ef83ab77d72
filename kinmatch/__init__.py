"""Record matching and data preparation on Spark."""
