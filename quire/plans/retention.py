"""K4: removal of files that no state names any more.

A folder is live if the state now, or the state at any log version whose entry
is younger than the grace time, names it: a reader that opened the workspace
within that time finds its files.  Other folders go once they are older than
the grace time themselves, so those of a run that has begun and not committed
stay.  The log, the staging tables, the ledger and the quarantine are records
and are never removed."""

from __future__ import annotations

import datetime as dt

from quire.sources.commitlog import CommitLog
from quire.sources.tables import STAGING_WIDTH, Workspace


def _named(log: CommitLog, oldest: int) -> set[str]:
    """The paths that the states from log version ``oldest`` on name."""
    ws, out = log.ws, set()
    state = log.state(oldest)
    states = [state]
    for v in log._versions(log.dir):
        if v > state.version:
            state = state.after(log._read(f"{log.dir}/{v:020d}.json"))
            states.append(state)
    for s in states:
        out |= {f"{ws.path('dim_articles')}/{kind}/{folder}" for folder in s.buckets.values() for kind in ("data", "stats")}
        out |= {*s.queues.values(), *([s.ledger] if s.ledger else [])}
    return out


def _children(ws: Workspace, path: str) -> list[tuple[str, int]]:
    """(path, newest modification within) of the folders of a folder."""
    fs, p = ws._fs(path)
    if not fs.exists(p):
        return []
    out = []
    for f in fs.listStatus(p):
        newest, inner = f.getModificationTime(), fs.listFiles(f.getPath(), True)
        while inner.hasNext():
            newest = max(newest, inner.next().getModificationTime())
        out.append((f"{path}/{f.getPath().getName()}", newest))
    return out


def clean(ws: Workspace, grace: dt.timedelta, now: dt.datetime | None = None) -> list[str]:
    """Remove what is out of reach; returns the paths."""
    log = CommitLog(ws)
    now = now or dt.datetime.now(dt.timezone.utc)
    before = (now - grace).timestamp() * 1000
    fs, p = ws._fs(log.dir)
    at = {int(str(f.getPath().getName())[:-5]): f.getModificationTime() for f in fs.listStatus(p) if str(f.getPath().getName())[0].isdigit()} if fs.exists(p) else {}
    # A version was the newest until the next one came.
    young = [v for v in at if v + 1 not in at or at[v + 1] >= before]
    live = _named(log, min(young)) if young else set()
    roots = [f"{ws.path('dim_articles')}/data", f"{ws.path('dim_articles')}/stats", ws.path("ledger_snapshot"), ws.path("_work"), *[ws.path(f"queue_{t}") for t in STAGING_WIDTH]]
    gone = [path for root in roots for path, newest in _children(ws, root) if path not in live and newest < before]
    for path in gone:
        fs, p = ws._fs(path)
        fs.delete(p, True)
    return gone
