"""Column expressions used by the operators. All run JVM-side."""
