"""Column expressions: vectors, globs, text, languages, labels."""
