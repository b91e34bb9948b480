"""Linking as records arrive: the same column functions over a stream, against a reference table at rest."""
