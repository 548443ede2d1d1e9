"""Readers and writers: landed files, versioned masters, relational tables."""
