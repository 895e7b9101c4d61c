"""Column functions. All are built from Spark's own expressions and run inside the JVM."""
