"""Column expressions: text, file names, times and personal-data patterns."""
