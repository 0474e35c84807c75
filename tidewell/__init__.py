"""tidewell: governed intake analytics and corpus preparation as plain Spark jobs."""
