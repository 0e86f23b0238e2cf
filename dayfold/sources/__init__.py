"""Readers, the dimension, and writers."""
