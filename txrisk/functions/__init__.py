"""Column expressions. Everything here is a built-in expression that stays in generated code."""
