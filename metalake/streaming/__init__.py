"""Structured Streaming: the object log in, index tables and the additions log out."""
