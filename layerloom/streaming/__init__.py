"""File streams feeding the history."""
