"""Operators for building text training data: one module per operator."""
