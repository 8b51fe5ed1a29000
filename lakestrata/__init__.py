"""Layered (raw -> silver -> gold -> delivery) analytics written as plain Spark jobs."""
