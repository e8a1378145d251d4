"""Small helpers shared by the tests."""


def rows(df, *order):
    """All rows as tuples, in a stable order."""
    found = [tuple(r) for r in df.collect()]
    return sorted(found, key=lambda r: tuple((v is not None, str(v)) for v in r))


def column(df, name):
    return [r[name] for r in df.collect()]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()
