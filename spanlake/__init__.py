"""spanlake: sequencing-variant analytics expressed as Spark DataFrame and SQL operators."""
