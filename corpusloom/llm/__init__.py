"""Operators for preparing training data; nothing outside of this subpackage imports it."""
