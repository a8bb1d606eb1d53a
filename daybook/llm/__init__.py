"""Training-data operators over text and embedding tables.

Nothing else in ``daybook`` imports this subpackage.  ``queries`` registers one
``opN_`` query per operator; ``corpus_pipeline`` at the repository top chains
five of them.
"""
