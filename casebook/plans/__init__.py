"""Reports, the batch job, and the queries checked against SQL."""
