"""Rows of a frame in a form that can be compared with the SQL oracle's."""


def same_rows(df):
    names = df.columns
    return sorted(map(str, (tuple(v for _, v in sorted(zip(names, r))) for r in df.collect())))
