"""Column-expression helpers: scalar functions and labels (all JVM-side)."""
