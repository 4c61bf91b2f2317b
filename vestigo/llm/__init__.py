"""Operators for training-data work on texts, vectors and rankings."""
