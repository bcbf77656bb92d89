"""Readers, writers and landing-zone checks."""
