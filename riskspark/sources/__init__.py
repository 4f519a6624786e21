"""Readers, writers, the run log and the model store."""
