"""Operators for preparing text, vectors and conversations for training language models."""
