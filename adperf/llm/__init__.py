"""Operators that prepare corpora for language-model training."""
