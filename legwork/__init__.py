"""Flight-delay analytics as PySpark DataFrame functions."""
