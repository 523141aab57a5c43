"""Range, band, code and set classification, each one flat CASE expression."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Range:
    """A closed range ``low..high`` with the value it stands for."""

    low: float
    high: float
    value: object


def _col(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _chain(cases: Sequence[tuple[Column, object]], default: object) -> Column:
    out = None
    for test, value in cases:
        out = F.when(test, F.lit(value)) if out is None else out.when(test, F.lit(value))
    return F.lit(default) if out is None else out.otherwise(F.lit(default))


def by_range(col: Column | str, ranges: Sequence[Range], default: object) -> Column:
    """Value of the range holding ``col``; no range or NULL gives the default.

    Where ranges overlap, the one listed last wins.
    """
    c = _col(col)
    return _chain([(c.between(r.low, r.high), r.value) for r in reversed(ranges)], default)


def by_band(
    col: Column | str, edges: Sequence[float], labels: Sequence[str], null_label: str | None = None
) -> Column:
    """Label of the half-open band: ``labels[i]`` below ``edges[i]``, the last one above them all.

    NULL falls in the last band unless ``null_label`` is given.
    """
    if len(labels) != len(edges) + 1:
        raise ValueError("one more label than edges is needed")
    c = _col(col)
    cases = [(c < e, label) for e, label in zip(edges, labels)]
    if null_label is not None:
        cases.insert(0, (c.isNull(), null_label))
    return _chain(cases, labels[-1])


def by_code(col: Column | str, labels: Mapping[str, str]) -> Column:
    """Label of a code through a literal map; an unknown code gives NULL."""
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(labels.items())])[_col(col)]


def by_set(col: Column | str, sets: Mapping[str, Sequence[str]], default: str) -> Column:
    """Name of the first set holding ``col``; none or NULL gives the default."""
    c = _col(col)
    return _chain([(c.isin(list(members)), name) for name, members in sets.items()], default)
