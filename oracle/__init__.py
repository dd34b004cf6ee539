"""DuckDB SQL twins of the registered Spark queries (the correctness oracle).

They are written independently of the Spark plans: matching is a direct
theta join with ``starts_with``, normalisation uses DuckDB's own
``nfc_normalize`` / ``strip_accents``.
"""
