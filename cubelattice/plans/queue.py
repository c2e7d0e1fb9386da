"""The sync queue's state machine: tasks and chunks of a small table, kept by one driver process.

Times are seconds since any epoch and are passed in, so transitions are deterministic."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

# Open states, seconds of a lease, tries, and words of errors that no retry mends.
ACTIVE = ("PENDING", "PLANNING", "RUNNING")
LEASE = 300.0
RETRIES = 3
PERMANENT = ("not found", "invalid", "permanent")


@dataclass(frozen=True)
class Task:
    task_id: int
    matrix: str
    years: tuple[int, int]
    mode: str = "totals-only"
    status: str = "PENDING"
    priority: int = 0
    created_at: float = 0.0
    locked_until: float | None = None
    error: str | None = None


@dataclass(frozen=True)
class Chunk:
    chunk_hash: str
    status: str = "PENDING"
    retries: int = 0
    next_retry: float | None = None
    locked_until: float | None = None
    error: str | None = None


@dataclass
class Queue:
    tasks: list[Task] = field(default_factory=list)
    chunks: dict[str, Chunk] = field(default_factory=dict)

    def submit(self, matrix: str, years: tuple[int, int], now: float, mode: str = "totals-only", priority: int = 0) -> tuple[Task, bool]:
        """The active task of the same parameters, or a new one; whether it is new."""
        for t in self.tasks:
            if (t.matrix, t.years, t.mode) == (matrix, years, mode) and t.status in ACTIVE:
                return t, False
        self.tasks.append(Task(len(self.tasks) + 1, matrix, years, mode, priority=priority, created_at=now))
        return self.tasks[-1], True

    def _set(self, task_id: int, **changes) -> Task:
        at = next(n for n, t in enumerate(self.tasks) if t.task_id == task_id)
        self.tasks[at] = replace(self.tasks[at], **changes)
        return self.tasks[at]

    def claim(self, now: float) -> Task | None:
        """The pending task of highest priority, oldest first; it gets a lease."""
        waiting = sorted((t for t in self.tasks if t.status == "PENDING"), key=lambda t: (-t.priority, t.created_at, t.task_id))
        return self._set(waiting[0].task_id, status="PLANNING", locked_until=now + LEASE) if waiting else None

    def start(self, task_id: int, now: float) -> Task:
        return self._set(task_id, status="RUNNING", locked_until=now + LEASE)

    def finish(self, task_id: int, error: str | None = None) -> Task:
        return self._set(task_id, status="FAILED" if error else "COMPLETED", error=(error or "")[:1000] or None, locked_until=None)

    def cancel(self, task_id: int) -> bool:
        task = next(t for t in self.tasks if t.task_id == task_id)
        if task.status not in ACTIVE:
            return False
        self._set(task_id, status="CANCELLED", locked_until=None)
        return True

    def retry(self, task_id: int) -> bool:
        task = next(t for t in self.tasks if t.task_id == task_id)
        if task.status not in ("FAILED", "CANCELLED"):
            return False
        self._set(task_id, status="PENDING", error=None)
        return True

    def release_stale(self, now: float) -> int:
        """Tasks and chunks whose lease has run out wait again."""
        stale = [t.task_id for t in self.tasks if t.status in ("PLANNING", "RUNNING") and t.locked_until is not None and t.locked_until < now]
        for task_id in stale:
            self._set(task_id, status="PENDING", locked_until=None)
        late = [k for k, c in self.chunks.items() if c.status == "IN_PROGRESS" and c.locked_until is not None and c.locked_until < now]
        for k in late:
            self.chunks[k] = replace(self.chunks[k], status="PENDING", locked_until=None)
        return len(stale) + len(late)

    def claim_chunk(self, now: float) -> Chunk | None:
        """A pending chunk, or a failed one whose time has come."""
        for k, c in self.chunks.items():
            if c.status == "PENDING" or c.status == "FAILED" and (c.next_retry is None or c.next_retry <= now):
                self.chunks[k] = replace(c, status="IN_PROGRESS", locked_until=now + LEASE)
                return self.chunks[k]
        return None

    def complete_chunk(self, key: str) -> None:
        self.chunks[key] = replace(self.chunks[key], status="COMPLETED", locked_until=None, error=None)

    def fail_chunk(self, key: str, error: str, now: float) -> Chunk:
        """Back off twice as long each time, 30 seconds at most; give up at the third or a permanent error."""
        c = self.chunks[key]
        retries = c.retries + 1
        over = retries >= RETRIES or any(p in error.lower() for p in PERMANENT)
        self.chunks[key] = replace(c, status="EXHAUSTED" if over else "FAILED", retries=retries, error=error[:1000], locked_until=None, next_retry=None if over else now + min(2.0 * 2**c.retries, 30.0))
        return self.chunks[key]
