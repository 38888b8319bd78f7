"""The registered queries once more, as plain SQL over the same tables."""
