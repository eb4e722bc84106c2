"""Registered queries (driver contract) and the fixtures they derive from
the driver's tables."""
