"""Column builders: every one is a plain Spark expression, so it stays in codegen."""
