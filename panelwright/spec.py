"""What a series is: keys, an order column, value columns and a frequency."""

from __future__ import annotations

from dataclasses import dataclass, replace

PERIODS_PER_YEAR = {"day": 365, "month": 12, "quarter": 4, "year": 1}
MONTHS_PER_PERIOD = {"month": 1, "quarter": 3, "year": 12}


@dataclass(frozen=True)
class SeriesSpec:
    """A panel of series inside a DataFrame.

    ``freq`` is a promise: the table holds one row per key and calendar
    period. A key then has at most a few hundred or thousand rows however
    large the input was, so a window partitioned by the keys is safe. Without
    ``freq`` a single key may hold any share of the table and every ordered
    operator works on bounded blocks of each series instead (see
    ``operators.layout``).

    ``tiebreak`` names the columns that order rows of equal ``time``.

    ``short`` says that every series is short although it has no frequency, as
    the orders of one customer are: its windows take a whole key at a time.

    ``slices`` is the number of ranges for numbering rows in parallel
    (``operators.layout.with_slices`` finds it once for a table and what is
    derived from it); it balances the work and never changes a result.
    """

    keys: tuple[str, ...] = ()
    time: str = "t"
    values: tuple[str, ...] = ("value",)
    freq: str | None = None
    tiebreak: tuple[str, ...] = ()
    short: bool = False
    slices: int | None = None

    def __post_init__(self) -> None:
        for name in ("keys", "values", "tiebreak"):
            got = getattr(self, name)
            object.__setattr__(self, name, (got,) if isinstance(got, str) else tuple(got))
        if self.freq is not None and self.freq not in PERIODS_PER_YEAR:
            raise ValueError(f"unknown frequency {self.freq!r}")

    @property
    def bounded(self) -> bool:
        return self.short or self.freq is not None

    @property
    def order(self) -> list[str]:
        return [self.time, *self.tiebreak]

    @property
    def periods_per_year(self) -> int:
        if self.freq is None:
            raise ValueError("a yearly change needs a series with a frequency")
        return PERIODS_PER_YEAR[self.freq]

    @property
    def months_per_period(self) -> int:
        if self.freq not in MONTHS_PER_PERIOD:
            raise ValueError("a month, quarter or year frequency is needed")
        return MONTHS_PER_PERIOD[self.freq]

    def with_values(self, *values: str) -> SeriesSpec:
        return replace(self, values=values)
