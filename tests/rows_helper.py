"""Shared by the tests of the main library."""


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)
