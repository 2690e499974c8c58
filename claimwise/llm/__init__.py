"""Operators for training-data preparation at corpus scale."""
