"""Column -> Column expressions (built-in Spark functions only, plus one Arrow UDF)."""
