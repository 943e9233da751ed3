"""News-article analytics as Spark DataFrame operators."""
