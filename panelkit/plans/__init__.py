"""Registered queries (``catalog``) and their DuckDB SQL twins (``oracle``)."""
