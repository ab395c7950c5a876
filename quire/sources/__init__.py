"""Readers and adapters."""
