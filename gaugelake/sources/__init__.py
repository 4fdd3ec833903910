"""Readers of landed files and registries."""
