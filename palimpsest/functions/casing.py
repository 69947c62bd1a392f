"""Name conversion between camelCase records and snake_case columns."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: a name breaks before every capital that is not its first letter.
CAPITAL = r"(?<!^)(?=[A-Z])"


def snake(name: str) -> str:
    return re.sub(CAPITAL, "_", name).lower()


def camel(name: str) -> str:
    head, *rest = name.split("_")
    return head + "".join(word.capitalize() for word in rest)


def snake_values(col: Column) -> Column:
    """`snake` over a column of names."""
    return F.lower(F.regexp_replace(col, CAPITAL, "_"))


def camel_values(col: Column) -> Column:
    """`camel` over a column of names."""
    words = F.split(col, "_")
    rest = F.transform(F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0))), F.initcap)
    return F.concat(words[0], F.array_join(rest, ""))
