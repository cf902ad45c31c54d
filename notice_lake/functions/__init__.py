"""Column-level building blocks: native expressions only, no Python workers."""
