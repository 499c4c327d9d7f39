"""Detection-label analytics as Spark DataFrame operators."""
