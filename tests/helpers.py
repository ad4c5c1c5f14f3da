"""Small comparisons shared by the tests."""

import math


def rows(df, *columns):
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda r: [(v is None, str(type(v)), str(v)) for v in r])


def same(a, b, tolerance=1e-9):
    if isinstance(a, float) or isinstance(b, float):
        if a is None or b is None:
            return a is b
        return math.isclose(a, b, rel_tol=tolerance, abs_tol=tolerance)
    return a == b


def assert_same(found, expected):
    """Compare a list of dicts with another, floats by tolerance, in the given order."""
    assert len(found) == len(expected), (len(found), len(expected))
    for f, e in zip(found, expected):
        for key, value in e.items():
            assert same(f[key], value), (key, f[key], value, e)


def mean(values):
    values = [v for v in values if v is not None]
    return sum(values) / len(values) if values else None
