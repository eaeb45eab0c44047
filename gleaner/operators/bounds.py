"""The size up to which one task settles a group whose steps depend on those before them; larger groups go another way."""

from __future__ import annotations

#: Rows of one group: leader passes, merge plans and greedy pairs. Beyond it they are settled in rounds, with the same result.
MOST = 200_000
