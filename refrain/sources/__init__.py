"""Readers, the logical data model and writers."""
