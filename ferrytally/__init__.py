"""Table migration and reconciliation as Spark jobs."""
