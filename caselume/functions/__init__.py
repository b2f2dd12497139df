"""Column expressions and the few DataFrame primitives the operators share."""
