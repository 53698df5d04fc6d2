"""Column expressions: text terms, paths, labels, costs and scores."""
