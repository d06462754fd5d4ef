"""Pipeline specifications and their runner."""
