"""Frame-level operators: every one is a plain DataFrame -> DataFrame function."""
