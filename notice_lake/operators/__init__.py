"""``DataFrame -> DataFrame`` operators: layers, keys, sequences, checks."""
