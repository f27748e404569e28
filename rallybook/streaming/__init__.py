"""The same rules on files that keep arriving."""
