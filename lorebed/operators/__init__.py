"""Relational operators of the knowledge pipeline. Order is a column here: every "first" is by an explicit ordinal."""
