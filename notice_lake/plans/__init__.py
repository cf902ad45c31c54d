"""Reports over the layers."""
