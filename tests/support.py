"""Helpers the test modules share; not a conftest, so a nested one cannot shadow it."""


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]
