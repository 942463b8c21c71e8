"""Readers of captions, pages and references, and writers."""
