"""Read settings, checked when they are made."""

from __future__ import annotations

import re
from dataclasses import dataclass, field, fields, replace
from datetime import timedelta

# What a job name may not hold, what it may not start with, and what stands in their place.
NOT_IN_NAMES, NAME_DASH = r"[^a-zA-Z0-9_]", "-"
NOT_FIRST, NAME_FIRST = r"\A[^a-zA-Z]", "a"


def queue_list(text: str) -> list[str]:
    """Comma-separated queue names. Blanks around a name and empty names are dropped."""
    return [name.strip() for name in text.split(",") if name.strip()]


def _above(least, **kwargs):
    """A field whose value, if it has one, must lie above ``least``."""
    return field(metadata={"above": least}, **kwargs)


@dataclass(frozen=True)
class ReadConfig:
    """What to read and how far.

    Without a limit the read is a stream, unless ``batch`` asks for all there is. ``options`` go to the Spark
    source as they are and may hold secrets, so they are never shown; which of them a source needs is for the
    source to say.
    """

    queues: list[str]
    use_sender_timestamp: bool = False
    poll_ms: int = _above(0, default=500)
    max_records: int | None = _above(0, default=None)
    max_read_time: timedelta | None = _above(timedelta(0), default=None)
    batch: bool = False
    max_files_per_trigger: int | None = _above(0, default=None)
    max_bytes_per_trigger: str | None = None
    options: dict | None = field(default=None, repr=False)

    def __post_init__(self):
        names = self.queues
        if isinstance(names, str) or not names or not all(isinstance(n, str) and n for n in names):
            raise ValueError(f"queues: expected a list of one name or more, got {names!r}")
        for setting in fields(self):
            value, least = getattr(self, setting.name), setting.metadata.get("above")
            if least is not None and value is not None and not value > least:
                raise ValueError(f"{setting.name}: expected more than {least}, got {value}")

    @property
    def bounded(self) -> bool:
        return self.batch or self.max_records is not None or self.max_read_time is not None

    @property
    def unique_queues(self) -> list[str]:
        """Names once each, first mention first. A repeated name asks for more readers, not more rows."""
        return list(dict.fromkeys(self.queues))

    @property
    def trigger(self) -> dict:
        return {"processingTime": f"{self.poll_ms} milliseconds"}

    @property
    def rate_options(self) -> dict:
        """Source options that bound one micro-batch, so unfinished work stays in step with the windows."""
        options = {"maxFilesPerTrigger": self.max_files_per_trigger, "maxBytesPerTrigger": self.max_bytes_per_trigger}
        return {name: str(value) for name, value in options.items() if value is not None}

    def with_(self, **changes) -> ReadConfig:
        return replace(self, **changes)

    def summary(self) -> str:
        """The settings that were made, on one line, fit for a log: no source option shows."""
        made = {f.name: getattr(self, f.name) for f in fields(self) if f.name != "options"}
        changed = {f.name: made[f.name] for f in fields(self) if f.name in made and made[f.name] != f.default}
        changed["queues"] = ",".join(self.unique_queues)
        return "read " + " ".join(f"{name}={value}" for name, value in changed.items())


def default_table_name(job_name: str) -> str:
    return job_name.replace("-", "_")


def normalize_job_name(name: str) -> str:
    """Job name safe for cluster managers: word characters and dashes, starting with a letter, lower case."""
    return re.sub(NOT_FIRST, NAME_FIRST, re.sub(NOT_IN_NAMES, NAME_DASH, name)).lower()
