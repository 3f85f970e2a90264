"""Readers, writers and column profiles."""
