"""Column expressions and frame-level primitives shared by the operators."""
