"""Operators a training-data pipeline needs: tokens, duplicates, filters, packing and chat formatting."""
