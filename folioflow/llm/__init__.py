"""Operators for building training data from a corpus. Nothing outside this subpackage imports it."""
