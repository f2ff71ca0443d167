"""Readers, and the versioned table folders that plans publish to."""
