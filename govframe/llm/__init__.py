"""Operators for preparing training data at large scale (URL, chat, HTML, dedup, decontamination, tokens).

Nothing else in the package imports this subpackage.
"""
