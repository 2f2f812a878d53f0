"""Rows of a frame in forms that tests compare."""


def as_dicts(df):
    return [r.asDict() for r in df.collect()]


def as_set(df):
    return {tuple(r) for r in df.collect()}
