"""Operators on text and vectors for training corpora, one module each."""
