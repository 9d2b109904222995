"""Registered queries: each module pairs a Spark query with its SQL check."""
