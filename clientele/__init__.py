"""Customer profiles and segments from review data, built on Spark."""
