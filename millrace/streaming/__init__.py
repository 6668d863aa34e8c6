"""Streaming of the curation engine."""
