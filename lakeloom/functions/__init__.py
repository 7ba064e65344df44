"""Column functions, all built from JVM-side Spark expressions."""
