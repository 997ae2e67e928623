"""What several test modules share; not in conftest.py, of which there is one per folder."""


def rows(df, *order):
    return sorted((tuple(r) for r in df.select(*(order or df.columns)).collect()), key=repr)
