"""Column-level building blocks: text in, columns out, no joins and no shuffles."""
