"""Streams of provider requests.  The reference has none: this is beyond it, and isn't counted as parity."""
