"""Layered models: raw, intermediate, mart, and the delay classifier."""
