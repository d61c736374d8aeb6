"""Inputs that several tests share."""

from __future__ import annotations

import random

# Columns that operators use themselves; a table may have them with any content.
CLASHING = (
    "id", "ids", "copy", "chunk", "blob", "size", "bucket", "kind", "fp", "group", "component", "score", "lang_pred",
    "held_out", "n_tokens", "posteriors", "rate", "n_removed", "kept", "spans", "node", "segment", "vector", "language",
)
SF = "/root/testdata/sf0.01"


def sentences(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdeéñ") for _ in range(r.randint(1, 7))) for _ in range(n))
