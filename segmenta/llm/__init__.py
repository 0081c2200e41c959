"""Training-data operators: search, packing, deduplication, tokenisation, language ID, licences, personal data.

Nothing else in the library imports this subpackage; ``queries`` registers one query per operator.
"""
