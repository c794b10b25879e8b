"""Whole jobs: building the table, the analytical queries, and what is registered to run."""
