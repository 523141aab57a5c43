"""The identity and clock of one run, passed explicitly to everything that needs them."""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import date, datetime, timezone


@dataclass(frozen=True)
class RunContext:
    """One run: its batch id, its timestamp and the business date rules compare against.

    Nothing in the library reads the wall clock while building a plan, so a run repeated with
    the same context gives the same tables.
    """

    batch_id: str
    run_ts: datetime
    as_of: date
    source_system: str = "source"

    @property
    def utc(self) -> datetime:
        """The run timestamp with its zone: one without a zone is meant in UTC, not in local time."""
        return self.run_ts if self.run_ts.tzinfo else self.run_ts.replace(tzinfo=timezone.utc)

    @classmethod
    def now(cls, source_system: str = "source", as_of: date | None = None) -> RunContext:
        ts = datetime.now(timezone.utc).replace(tzinfo=None)
        return cls(uuid.uuid4().hex[:8], ts, as_of or ts.date(), source_system)
