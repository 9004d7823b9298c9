"""Column-level helpers (V1-V9 and the scalar parts of P/E operators)."""

from traitlab.functions.columns import *  # noqa: F401,F403
