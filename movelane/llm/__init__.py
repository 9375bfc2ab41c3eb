"""Operators for training data: grouping, names, page bodies, survivors, canonical values, tokens, mixtures, residue."""
