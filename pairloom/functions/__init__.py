"""Column functions: identifiers, text, numbers and dates."""
