"""Commerce order and review analytics as Spark DataFrame operators."""
