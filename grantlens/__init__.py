"""Research-grant analytics as Spark DataFrame operators."""
