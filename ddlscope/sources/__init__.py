"""Readers of snapshot tables and of stored API responses."""
