"""Column functions: identifiers, hashing, text and similarity."""
