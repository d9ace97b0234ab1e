"""Customer-support conversation analytics as Spark DataFrame operators."""
