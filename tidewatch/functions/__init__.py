"""Column expressions (JVM-side) and small numeric finishes."""
