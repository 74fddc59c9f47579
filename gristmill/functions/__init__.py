"""Column functions: text, parsing, vectors. Each takes and returns a ``Column``."""
