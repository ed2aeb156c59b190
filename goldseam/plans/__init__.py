"""Layered jobs per domain (``sales``, ``airline``, ``claims``) and the queries bound to the test tables."""
