"""Relational operators: cleaning, quality, transforms, dimensions, facts, ranking."""
