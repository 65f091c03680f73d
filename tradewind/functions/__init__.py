"""Column functions: no joins, no aggregates, everything stays in the JVM."""
