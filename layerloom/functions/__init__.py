"""Column expressions: types, casts, text cleaning, hashing."""
