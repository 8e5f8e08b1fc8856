"""Column builders. Nothing here runs a job or touches Python per row."""
