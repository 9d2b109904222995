"""Spark toolkit for landing, loading, monitoring and protecting tables."""
