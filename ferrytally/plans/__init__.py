"""Composite jobs: comparison reports, migrations, batches, staging models."""
