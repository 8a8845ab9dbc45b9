"""Readers of bronze and silver data, writers of silver and gold tables."""
