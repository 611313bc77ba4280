"""Incremental landing: new files in a landing folder become Bronze rows."""
