"""Registered queries over the driver's star-schema test tables.

``star`` derives the domain inputs (payment declarations, prescriptions,
product catalogue, postal-code points) from those tables with plain
DataFrame expressions; ``queries`` runs the library's marts and queries on
them; ``oracle`` holds the same computations written as DuckDB SQL.
"""
