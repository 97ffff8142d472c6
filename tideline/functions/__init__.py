"""Column expressions: object keys, names, arrays, texts and quota figures."""
