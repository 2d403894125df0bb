from __future__ import annotations

import logging
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import datetime, timezone

from starmart.operators.lookup import BROADCAST_BYTES, SLICE_ROWS
from starmart.operators.scd import BEGINNING
from starmart.sources.warehouse import Warehouse

_LOG = logging.getLogger("starmart")


@dataclass(frozen=True)
class LoadOptions:
    """Choices of a load.  The defaults are the safe ones.

    fact_mode: ``insert_if_absent`` | ``insert_only`` | ``upsert``
    bounds: ``closed`` counts a version's last day as valid, ``half_open`` does not
    emit: product key in facts, ``sk`` (version) | ``natural``
    first_version_from: start of the first version of a new product; ``run_date`` for the run's day
    marks_after_full: ``reset`` rereads everything in the next incremental run, ``run_ts`` does not
    overlap_seconds: read this much before the mark again, for rows committed late at the source
    fact_ranges: write the facts of a full load in so many ranges of the opportunity, each noted in the log; a load that is cut
        short and run again with the same ``run_ts`` writes only the ranges that are missing
    replay: rejects tried again in a run, ``arrived``: those that wait for a key which a dimension gained | ``all``
    validate: check the tables after each load and note the violations in the load log; facts by the summaries that loads
        keep of them, or with ``full`` by reading them all
    max_broadcast: most bytes of one broadcast; slice_rows: most rows of one key for a task
    """

    fact_mode: str = "insert_if_absent"
    bounds: str = "closed"
    emit: str = "sk"
    first_version_from: str = BEGINNING
    marks_after_full: str = "reset"
    overlap_seconds: int = 0
    fact_ranges: int = 1
    replay: str = "arrived"
    validate: bool | str = True
    max_broadcast: int = BROADCAST_BYTES
    slice_rows: int = SLICE_ROWS

    @property
    def sizes(self) -> dict[str, int]:
        return {"max_broadcast": self.max_broadcast, "slice_rows": self.slice_rows}


@contextmanager
def logged(wh: Warehouse, batch_id: str, run_ts: str):
    """Record a failing run in the error log; nothing of it is published."""
    try:
        yield
    except Exception as e:
        wh.log_error(batch_id, run_ts, e)
        raise


def utc(run_ts: str) -> str:
    """``run_ts`` as UTC text without an offset: the one form that windows, marks, run dates and batch ids use."""
    at = datetime.fromisoformat(run_ts)
    return (at if at.tzinfo is None else at.astimezone(timezone.utc).replace(tzinfo=None)).isoformat()


def batch_name(run_ts: str) -> str:
    return "".join(c for c in run_ts if c.isalnum())


def loaded_before(wh: Warehouse, batch_id: str) -> bool:
    """Is the batch committed?  Said aloud, as the call then does nothing."""
    if not wh.committed(batch_id):
        return False
    _LOG.warning("batch %s is committed already; nothing is loaded again", batch_id)
    return True
