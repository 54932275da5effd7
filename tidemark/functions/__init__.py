"""Column functions: calendar, units, identifiers."""
