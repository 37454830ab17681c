"""The registered queries: the library's operators over the given tables, each with its SQL twin."""

from railmart.catalog import fact, geo, names, rides, sources, timetable

MODULES = [geo, timetable, fact, names, rides, sources]


def all_queries() -> dict:
    return {name: fn for module in MODULES for name, fn in module.QUERIES.items()}


def all_sql() -> dict[str, str]:
    return {name: sql for module in MODULES for name, sql in module.SQL.items()}
