"""Tables and landing folders that are read."""
