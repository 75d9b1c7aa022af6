"""Operators for preparing training corpora (README, "Corpus operators").

Nothing outside this folder imports it.
"""
