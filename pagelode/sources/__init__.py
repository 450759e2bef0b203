"""Readers, writers and codecs at the edges of the engine."""
