"""Readers of road networks, terrain tiles and records."""
