"""Scalar expressions. Each takes and returns Columns and stays inside the JVM."""
