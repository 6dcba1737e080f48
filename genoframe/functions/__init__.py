"""Column functions: no Python runs for any of them."""
