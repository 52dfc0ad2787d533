"""Column builders: text cleaning, term lists, structural measures."""
