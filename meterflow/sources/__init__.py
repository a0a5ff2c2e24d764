"""Readers, writers and table bindings."""
