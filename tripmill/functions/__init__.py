"""Column functions: calendar, labels, measures."""
