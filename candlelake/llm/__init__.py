"""Operators for preparing training text and vectors at scale.

Nothing else in the package imports this folder; its queries are registered by
``candlelake.llm.queries``.
"""
