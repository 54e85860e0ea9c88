"""Connected components and stored tables, as the operators use them."""

from __future__ import annotations

from seatledger.operators.graph import components
from seatledger.session import stored

__all__ = ["components", "stored"]
