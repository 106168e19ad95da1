"""Readers. Every one declares its schema; nothing is inferred."""
