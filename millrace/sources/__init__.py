"""Readers, manifests and sinks."""
