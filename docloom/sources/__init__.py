"""Where documents come from and where writes go."""
