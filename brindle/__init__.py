"""Table operators and machine-learning jobs written as Spark DataFrame programs."""
