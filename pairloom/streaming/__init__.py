"""The stateless operators on rows that keep arriving."""
