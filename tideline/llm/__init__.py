"""Operators for preparing training corpora, and the queries that run them over whole tables."""
