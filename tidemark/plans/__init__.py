"""Composite plans: landing (bronze), cleaning (silver), marts (gold), extracts, checks."""
