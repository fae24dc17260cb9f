"""Readers, writers and the tables kept around a run."""
