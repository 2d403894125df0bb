"""Star-schema loading and maintenance as Spark DataFrame operators."""
