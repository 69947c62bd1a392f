from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from palimpsest.session import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = session(
        "tests",
        master="local[8]",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__driver__memory="8g",
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


def rows(df, *order):
    """Rows as dicts, in a stable order."""
    out = [r.asDict(recursive=True) for r in df.collect()]
    names = order or tuple(df.columns)
    return sorted(out, key=lambda r: tuple((r[n] is None, str(r[n])) for n in names))
