"""Readers of saved responses, zone, station and reading files; table writers."""
