"""Readers, writers and input contracts."""
