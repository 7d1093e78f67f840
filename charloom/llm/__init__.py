"""Training-data operators: quality, decontamination, language, tokens, near duplicates, secrets.

Nothing else in the package imports this subpackage; its queries are in
``charloom.llm.queries``.
"""
