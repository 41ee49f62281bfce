"""Readers with explicit schemas and checks, and writers of the public artifacts."""
