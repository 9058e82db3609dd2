"""Registered queries and their SQL twins, the scenario parameters, and file-to-file jobs."""
