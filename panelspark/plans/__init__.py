"""The analysis jobs, one DataFrame function each (see ``catalog`` for the registry)."""
