"""Rows of Spark and DuckDB in one form."""

import datetime
import decimal


def plain(value):
    if isinstance(value, float):
        return None if value != value else round(value, 6)
    if isinstance(value, decimal.Decimal):
        return round(float(value), 6)
    if isinstance(value, (list, tuple)):
        return tuple(plain(x) for x in value)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def rows_of(df):
    names = sorted(df.columns)
    return names, sorted(repr(tuple(plain(r[n]) for n in names)) for r in df.collect())


def rows_of_sql(duck, sql):
    found = duck.sql(sql)
    order = sorted(range(len(found.columns)), key=lambda i: found.columns[i])
    return sorted(found.columns), sorted(repr(tuple(plain(r[i]) for i in order)) for r in found.fetchall())
