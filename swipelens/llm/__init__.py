"""Operators that prepare text for training language models, and their named queries."""
