"""Order-insensitive comparison of whole frames."""

from collections import Counter


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(row[i] for i in order) for row in rows)


def spark_rows(df):
    return sorted(df.columns), rows_of(df.columns, [tuple(r) for r in df.collect()])


def duck_rows(connection, sql):
    result = connection.execute(sql)
    columns = [d[0] for d in result.description]
    return sorted(columns), rows_of(columns, result.fetchall())
