"""Whole derivations, and the registered queries over a virtual road network."""
