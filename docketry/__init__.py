"""Document, call-data and change-data analytics as Spark DataFrame operators."""
