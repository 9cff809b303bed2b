"""Survey, panel, posting and text analytics as lazy Spark DataFrame jobs."""
