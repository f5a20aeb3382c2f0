"""Column-to-Column helpers; built-in expressions only."""
