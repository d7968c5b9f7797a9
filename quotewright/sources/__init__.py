"""Readers, writers and the shared storage they use."""
