"""Corpus, question and answer files."""
