"""Column builders shared by the jobs."""
