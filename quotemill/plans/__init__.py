"""Summary tables, dashboard queries and batch jobs."""
