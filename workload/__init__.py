"""Itinerary, flight and fare tables derived from the given tables, and the
queries and oracle SQL that run on them. Not part of the library."""
