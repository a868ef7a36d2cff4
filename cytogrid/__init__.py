"""cytogrid: spatial single-cell analytics expressed as Spark DataFrame jobs."""
