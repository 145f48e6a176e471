"""Structured Streaming versions of the changelog operators."""
