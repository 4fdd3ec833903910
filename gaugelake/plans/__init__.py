"""Archive tables, named reports and jobs."""
