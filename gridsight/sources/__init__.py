"""Readers, writers and lookup relations."""
