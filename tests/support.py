"""Small helpers the tests share."""

import contextlib
import io
import math


def rows(df):
    """Rows as sorted tuples, NULL-safe."""
    return sorted((tuple(r) for r in df.collect()), key=repr)


def plan(df):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()


def clean(value):
    return None if isinstance(value, float) and math.isnan(value) else value


def by_name(columns, values):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted((tuple(clean(r[i]) for i in order) for r in values), key=repr)
