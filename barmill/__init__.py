"""Spark jobs for daily price bars."""
