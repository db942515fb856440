"""Relational operators over chunks, vectors, conversations and scores."""
