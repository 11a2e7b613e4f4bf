"""Operators for large training corpora: cleaning, de-duplication, mixing and packing."""
