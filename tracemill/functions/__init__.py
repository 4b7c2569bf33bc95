"""Column expressions and the few Arrow functions Spark cannot express."""
