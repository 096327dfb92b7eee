"""Operators for preparing text for language-model training."""
