"""Landed files as streams into the masters."""
