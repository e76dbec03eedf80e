"""Readers for raw messages and history tables."""
