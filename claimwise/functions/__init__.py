"""Column-level helpers built from Spark SQL functions."""
