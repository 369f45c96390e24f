"""ampertide: fleet cost and emission analytics as Spark DataFrame operators."""
