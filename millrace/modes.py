"""Save modes."""

from __future__ import annotations

# The modes a task may name; any other text means append.
SAVE_MODES = ("overwrite", "append", "errorifexists", "ignore")


def save_mode(text: object | None) -> str:
    name = str(text or "").strip().lower()
    return name if name in SAVE_MODES else "append"
