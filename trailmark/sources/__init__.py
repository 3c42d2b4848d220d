"""Readers for the action log, dimension tables, tasks and click streams."""
