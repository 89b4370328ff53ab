"""Incremental runs of the same stateless extracts over a drop folder."""
