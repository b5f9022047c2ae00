"""Readers of captured tables and files."""
