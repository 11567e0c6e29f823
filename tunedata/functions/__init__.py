"""Column -> Column expressions. All but ``syntax`` are built-in Spark expressions."""
