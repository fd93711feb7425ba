"""Column-expression helpers (all JVM-side, no Python UDFs)."""
