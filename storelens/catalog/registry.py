"""All registered queries."""

from __future__ import annotations

from storelens.catalog import io, logs, questions, retrieval, texts
from storelens.catalog.entry import Entry

ENTRIES: dict[str, Entry] = {
    **questions.ENTRIES, **texts.ENTRIES, **retrieval.ENTRIES, **logs.ENTRIES,
    **io.ENTRIES,
}
