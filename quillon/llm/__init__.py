"""Operators for building training corpora at scale.  Nothing outside this subpackage imports it."""
