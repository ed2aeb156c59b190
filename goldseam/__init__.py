"""Goldseam: layered (bronze, silver, gold) analytics as Spark DataFrame operators.

``sources``    readers, sinks and catalog checks
``functions``  column expressions (dates, text, scores, exact fixed-point money)
``operators``  DataFrame-in, DataFrame-out operators, parameterised by column name
``plans``      the layered jobs of each domain, and the queries bound to the test tables
"""
