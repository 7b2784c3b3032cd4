"""Whole runs that chain operators, and the queries registered for the driver tables."""
