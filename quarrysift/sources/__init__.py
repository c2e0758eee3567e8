"""File trees, file tables, ignore rules and settings files."""
