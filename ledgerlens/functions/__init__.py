"""Column expressions (pure ``pyspark.sql.Column`` builders)."""
