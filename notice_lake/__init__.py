"""Lakehouse layers for streams of human-readable ``KEY: VALUE`` notices.

Every layer and report is a plain ``DataFrame -> DataFrame`` function, so batch
jobs, Structured Streaming queries and tests share one definition.
"""
