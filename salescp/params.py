"""Parameters of the sales change-point engine.

The block marked "fixed values" holds the literals the original job set
hard-codes; they are the defaults here and every operator takes them as
arguments.  The block after it holds the stand-ins used with the
driver-generated fixture tables, where the original literals match nothing.
"""

from __future__ import annotations

from dataclasses import dataclass

# --- fixed values (must equal the original job set's literals) -------------
DEFAULT_DEPARTMENTS = ("MONTEVIDEO", "CANELONES")  # stores kept
DEFAULT_EXCLUDED_CATEGORY = "CENSURADO"  # product category dropped
PRICE_MIN = 10.0  # unit price lower bound, inclusive
PRICE_MAX = 2000.0  # unit price upper bound, inclusive
QUANTITY_MIN = 0.0  # original quantity lower bound, inclusive
MIN_POINTS = 3  # minimum points per segment (regression and ED-PELT)
REGRESSION_RATIO = 0.7  # split flagged when left+right error < ratio * whole
MAX_SECONDS_PER_SERIES = 180  # time budget per series of the original jobs; here an opt-in argument
DIVIDE_SEGMENTS = 8  # segments of divide-PELT
DATE_FORMAT = "yyyy-MM-dd"
FIELD_SEPARATOR = ";"
TIMEOUT_TOKEN = "Timeout"
# ---------------------------------------------------------------------------

# Stand-ins for the fixture tables (TPC-H-like): regions play departments,
# brands or part types play categories.
FIXTURE_DEPARTMENTS = ("AFRICA", "AMERICA")
FIXTURE_EXCLUDED_CATEGORY = "Brand#10"

# Dimension tables within both bounds (after de-duplication and filters) are
# broadcast; larger ones go through a shuffle join.  Rows and the bytes of their
# texts are counted while the dimension is written; a row counts 32 bytes besides
# its text (key, pointers and length).
BROADCAST_MAX_ROWS = 1_000_000
BROADCAST_MAX_BYTES = 64 << 20
BROADCAST_ROW_BYTES = 32


@dataclass(frozen=True)
class Filters:
    """Literals of the store, product and sales filters."""

    departments: tuple[str, ...] = DEFAULT_DEPARTMENTS
    excluded_category: str | None = DEFAULT_EXCLUDED_CATEGORY
    price_min: float = PRICE_MIN
    price_max: float = PRICE_MAX
    quantity_min: float = QUANTITY_MIN

    @staticmethod
    def fixture() -> "Filters":
        return Filters(FIXTURE_DEPARTMENTS, FIXTURE_EXCLUDED_CATEGORY)
