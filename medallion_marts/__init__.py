"""Batch and streaming jobs for municipal revenue analytics on Spark."""
