"""Operators put together: preprocessing, dataset assembly, training."""
