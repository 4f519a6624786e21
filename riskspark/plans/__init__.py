"""Whole jobs: preparation, training, promotion and batch scoring."""
