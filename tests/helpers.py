import io
from contextlib import redirect_stdout

import pandas as pd


def frame(spark, data: dict, schema: str):
    """A table from columns of Python values, None meaning missing."""
    return spark.createDataFrame(list(zip(*data.values())), schema)


def local(df, *keys) -> pd.DataFrame:
    table = df.toPandas()
    return table.sort_values(list(keys)).reset_index(drop=True) if keys else table


def plan(df) -> str:
    text = io.StringIO()
    with redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()


def same(a, b, digits: int = 9) -> bool:
    """Equal values, missing equal to missing."""
    if pd.isna(a) or pd.isna(b):
        return bool(pd.isna(a) and pd.isna(b))
    if isinstance(a, (float, int)) and isinstance(b, (float, int)):
        return abs(float(a) - float(b)) <= 10 ** -digits * max(1.0, abs(float(a)))
    return a == b


def assert_columns(ours, theirs, digits: int = 9) -> None:
    ours, theirs = list(ours), list(theirs)
    assert len(ours) == len(theirs), (len(ours), len(theirs))
    wrong = [(i, a, b) for i, (a, b) in enumerate(zip(ours, theirs)) if not same(a, b, digits)]
    assert not wrong, wrong[:5]
