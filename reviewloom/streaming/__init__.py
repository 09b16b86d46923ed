"""The load on a file stream."""
