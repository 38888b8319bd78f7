"""Loading, checking and writing tables."""
