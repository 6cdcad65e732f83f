"""Operators for preparing training data at corpus scale, and their queries."""
