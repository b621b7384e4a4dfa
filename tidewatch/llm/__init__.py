"""Training-data operators (deduplication, filtering, search, mixing, archives).

Nothing outside this subpackage imports it; ``queries.py`` lists the
registered queries and ``oracle_sql.py`` their DuckDB SQL.
"""
