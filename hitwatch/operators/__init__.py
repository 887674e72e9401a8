"""``DataFrame -> DataFrame`` functions, the same for batch and streaming input."""
