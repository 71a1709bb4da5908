"""Column functions: identity, paths and text."""
