"""Column functions: Column in, Column out, all on built-in expressions."""
