"""Operators for preparing language-model training data.

One module per operator, ``common`` for what they share, and ``q_llm`` for
their registered queries.  Nothing else in the library imports this package.
"""
