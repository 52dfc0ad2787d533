"""Scoring a stream of new documents with fitted features."""
