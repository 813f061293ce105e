"""Column builders and literal casting."""
