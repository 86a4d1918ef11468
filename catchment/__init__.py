"""Service-coverage analytics as Spark DataFrame jobs."""
