"""Spark jobs for versioned, structured document corpora."""
