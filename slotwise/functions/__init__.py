"""Column-expression builders (JVM-side, no Python UDFs)."""
