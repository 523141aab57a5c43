"""Flagging and filling of missing values. Fill values are found without gathering the column."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamina.runtime import materialize

# Values a single exact percentile may hold at once; longer ranges are narrowed first.
_EXACT_VALUES = 1_000_000


def flag_nulls(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Add ``is_null_<col>`` (0/1) for each column."""
    return df.withColumns({f"is_null_{c}": F.col(c).isNull().cast("int") for c in cols})


@dataclass
class _Search:
    """The values of the ranks ``low`` and ``high`` (1-based, ``high`` is ``low`` or behind it) of one column.

    They are among its ``n`` values in the range that ``inside`` tells; ``found`` are they once known.
    """

    col: str
    low: int
    high: int
    n: int
    inside: Column
    found: tuple[float, float] | None = None

    @property
    def value(self) -> Column:
        """The column's values in the range, NULL outside, which aggregates leave out."""
        return F.when(self.inside, F.col(self.col))

    def near(self) -> Column:
        """Two estimated values that enclose the ranks."""
        ranks = [max(0.0, (self.low - 1) / self.n - 0.001), min(1.0, self.high / self.n + 0.001)]
        return F.percentile_approx(self.value, ranks, F.lit(10_000))

    def counts(self, a: float, b: float) -> Column:
        """Exact numbers of values below, at and between the two, and their neighbours."""
        c = self.value
        return F.struct(
            F.count_if(c < a).alias("below"), F.count_if(c == a).alias("at_a"), F.count_if(c.between(a, b)).alias("within"),
            F.max(F.when(c < a, c)).alias("before"), F.min(F.when(c > a, c)).alias("behind"), F.min(F.when(c > b, c)).alias("beyond"),
        )

    def narrow(self, a: float, b: float, told: Row) -> None:
        """Go on in the part that the counts say the ranks are in."""
        c, below, at_a, within = F.col(self.col), told["below"], told["at_a"], told["within"]
        if self.high <= below:
            self.inside, self.n = self.inside & (c < a), below
            return
        if self.low <= below + at_a:
            self.found = (told["before"] if self.low <= below else a, a if self.high <= below + at_a else told["behind"])
            return
        if self.low <= below + within < self.high:
            self.found = (b, told["beyond"])
            return
        if self.high <= below + within:
            self.inside, self.n, skipped = self.inside & (c > a) & (c <= b), within - at_a, below + at_a
        else:
            self.inside, self.n, skipped = self.inside & (c > b), self.n - below - within, below + within
        self.low, self.high = self.low - skipped, self.high - skipped


def medians(df: DataFrame, cols: Sequence[str], held: int = _EXACT_VALUES) -> dict[str, float | None]:
    """Exact medians of numeric columns, each the mean of the two middle values for an even count; None without values.

    The columns are written to the scratch folder and searched together. The range around each middle is narrowed
    by estimated percentiles with exact counts, two aggregates a step for all columns, until every range holds at most
    ``held`` values, of which one exact aggregate picks all. The number of jobs follows the steps of the
    column that needs most and not the number of columns.
    """
    if not cols:
        return {}
    names = {c: f"v{i}" for i, c in enumerate(cols)}
    values = materialize(df.select(*[F.col(f"`{c}`").cast("double").alias(v) for c, v in names.items()]), "medians")
    counts = values.agg(*[F.count(v).alias(v) for v in names.values()]).first()
    searches = [
        _Search(v, (counts[v] + 1) // 2, counts[v] // 2 + 1, counts[v], F.col(v).isNotNull())
        for v in names.values() if counts[v]
    ]
    while wide := [s for s in searches if s.found is None and s.n > held]:
        near = values.agg(*[s.near().alias(s.col) for s in wide]).first()
        told = values.agg(*[s.counts(*near[s.col]).alias(s.col) for s in wide]).first()
        for s in wide:
            s.narrow(*near[s.col], told[s.col])
    if narrow := [s for s in searches if s.found is None]:
        held_values = values.select(*[s.value.alias(s.col) for s in narrow])
        picked = held_values.agg(*[rank for s in narrow for rank in _ranks(s)]).first()
        for s in narrow:
            s.found = picked[f"{s.col}_low"], picked[f"{s.col}_high"]
    middle = {s.col: s.found[0] + (s.found[1] - s.found[0]) / 2 for s in searches}
    return {c: middle.get(v) for c, v in names.items()}


def _ranks(s: _Search) -> list[Column]:
    """The values of both ranks, exactly."""
    return [
        F.expr(f"percentile_disc({(rank - 0.5) / s.n}D) WITHIN GROUP (ORDER BY {s.col})").alias(f"{s.col}_{name}")
        for name, rank in (("low", s.low), ("high", s.high))
    ]


def median(df: DataFrame, col: str, held: int = _EXACT_VALUES) -> float | None:
    """The exact median of one numeric column (``medians``)."""
    return medians(df, [col], held)[col]


def modes(df: DataFrame, cols: Sequence[str]) -> dict[str, object]:
    """Most frequent value of each column, the smallest of equally frequent ones; NULL is not a value.

    One pass and one shuffle for all columns: every value is counted beside the number of its column, combined in
    each task, and the best of each column is kept.
    """
    if not cols:
        return {}
    fields = [f"v{i}" for i in range(len(cols))]
    types = [df.schema[c].dataType for c in cols]
    # A row for each column, with its value in a field of its own type and all other fields NULL.
    each = F.array(*[
        F.struct(F.lit(i).alias("of"), *[
            (F.col(f"`{c}`") if j == i else F.lit(None).cast(types[j])).alias(fields[j]) for j in range(len(cols))
        ]) for i, c in enumerate(cols)
    ])
    told = df.select(F.explode(each).alias("x")).select("x.*")
    known = F.coalesce(*[F.when(F.col(f).isNotNull(), F.lit(True)) for f in fields], F.lit(False))
    counts = told.where(known).groupBy("of", *fields).agg(F.count(F.lit(1)).alias("n"))
    # Within a column all other fields are NULL, so that the order is that of the counts and then of its values.
    best = counts.groupBy("of").agg(F.min(F.struct((-F.col("n")).alias("n"), *fields)).alias("best")).collect()
    found = {row["of"]: row["best"][fields[row["of"]]] for row in best}
    return {c: found.get(i) for i, c in enumerate(cols)}


def mode(df: DataFrame, col: str):
    """The mode of one column (``modes``)."""
    return modes(df, [col])[col]


def fill(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Replace NULLs by one value per column, keeping the column's type."""
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.withColumns(
        {
            c: F.coalesce(F.col(c), F.lit(v).cast(types[c]))
            for c, v in values.items()
            if v is not None
        }
    )


def handle_nulls(
    df: DataFrame, default: str, overrides: Mapping[str, str], cols: Iterable[str]
) -> DataFrame:
    """Apply a policy per column: ``flag``, ``impute_median``, ``impute_mode``, ``impute`` or ``exclude``.

    ``impute`` fills numbers with the median and everything else with the mode. Imputed columns are flagged too, so that a filled value stays recognisable.
    """
    cols = list(cols)
    numbers = {f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)}
    how = {c: overrides.get(c, default) for c in cols}
    how = {c: ("impute_median" if c in numbers else "impute_mode") if h == "impute" else h for c, h in how.items()}
    unknown = set(how.values()) - {"flag", "impute_median", "impute_mode", "exclude"}
    if unknown:
        raise ValueError(f"unknown null handling {sorted(unknown)}")
    out = flag_nulls(df, [c for c in cols if how[c] != "exclude"])
    values = medians(df, [c for c in cols if how[c] == "impute_median"])
    values |= modes(df, [c for c in cols if how[c] == "impute_mode"])
    excluded = [c for c in cols if how[c] == "exclude"]
    out = fill(out, values)
    return out.dropna(subset=excluded) if excluded else out
