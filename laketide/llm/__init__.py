"""Operators for preparing training text: PII, language, repeats, packing,
similarity, exact copies, URL rules, contamination, quality, licences.

Nothing else in the library imports this subpackage. Its queries are in
``laketide.llm.queries``.
"""
