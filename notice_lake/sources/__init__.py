"""Where messages and layers are read from and written to."""
