"""Service-parts demand analytics as Spark DataFrame plans."""
