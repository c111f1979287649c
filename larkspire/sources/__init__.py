"""Where collections are read from."""
