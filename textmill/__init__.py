"""Text corpus preparation and counted n-gram analytics as Spark DataFrame functions."""
