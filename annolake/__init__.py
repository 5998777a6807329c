"""Detection-dataset analytics as plain PySpark DataFrame operators."""
