"""Lexalign: aligned, token-annotated text corpora as lazy Spark DataFrame transforms."""
