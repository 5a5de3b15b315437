"""Readers, normalisers and writers around the lake."""
