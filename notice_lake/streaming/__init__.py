"""Structured Streaming runs of the layer functions."""
