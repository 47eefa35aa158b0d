"""Training-data operators: cleaning, deduplication, mixing, packing, scoring.

Nothing outside this subpackage imports it. ``registry.QUERIES`` holds the
``opN_<name>`` queries, ``registry.ORACLE_SQL`` their DuckDB SQL where SQL can
express them.
"""
