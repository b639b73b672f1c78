"""Feature analytics over invoice and balance tables, written for Spark."""
