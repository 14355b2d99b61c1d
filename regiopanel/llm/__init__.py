"""Operators for preparing language-model training data at corpus scale.

Each module holds one operator and its general interface; ``queries`` applies
them to the test tables. Nothing outside this folder imports it except the
entry file and ``corpus_pipeline``.
"""
