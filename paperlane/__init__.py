"""Document-classification analytics as plain Spark DataFrame operators."""
