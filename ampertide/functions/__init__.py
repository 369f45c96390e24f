"""Column functions: cleaning, parsing, code mapping and arithmetic."""
