"""Tables and files that are written."""
