"""Jobs composed of operators and sources: prepare, train, score."""
