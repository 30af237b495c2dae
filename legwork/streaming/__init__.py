"""Incremental load of landed pages."""
