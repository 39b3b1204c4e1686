"""Fixed values the results depend on.

Fixed values (they must equal the original service's for equal results):
supported chains, in the order the route grid lists them:
    arbitrum, base, bitcoin, ethereum, hyperliquid, starknet, bera, unichain
chains whose event times are looked up by transaction hash:
    ethereum, arbitrum, bitcoin
refund stage offset: 2 hours; default analysis window: 30 days;
default page: 1; default page size: 10; IST display offset: +05:30.
"""

from __future__ import annotations

SUPPORTED_CHAINS: tuple[str, ...] = (
    "arbitrum",
    "base",
    "bitcoin",
    "ethereum",
    "hyperliquid",
    "starknet",
    "bera",
    "unichain",
)

TX_LOOKUP_CHAINS: tuple[str, ...] = ("ethereum", "arbitrum", "bitcoin")

REFUND_OFFSET_US: int = 2 * 3600 * 1_000_000
DEFAULT_WINDOW_DAYS: int = 30
DEFAULT_PAGE: int = 1
DEFAULT_PER_PAGE: int = 10
IST_OFFSET: str = "+05:30"

# Of the tables and intermediate rows that are written: ids and hashes take about half of what they do in Spark's default.
COMPRESSION: str = "zstd"

# The six lifecycle events, the side whose chain each lives on, and the stage
# durations named after them (they are column names of the stored table).
EVENTS: tuple[str, ...] = (
    "user_init",
    "cobi_init",
    "user_redeem",
    "cobi_redeem",
    "user_refund",
    "cobi_refund",
)
EVENT_SIDE: dict[str, str] = {
    "user_init": "source",
    "cobi_redeem": "source",
    "user_refund": "source",
    "cobi_init": "destination",
    "user_redeem": "destination",
    "cobi_refund": "destination",
}

# The four stage durations that get quartiles, fences and anomaly tests.
FENCED_METRICS: tuple[str, ...] = ("user_init", "cobi_init", "user_redeem", "cobi_redeem")
ALL_METRICS: tuple[str, ...] = (
    "user_init",
    "cobi_init",
    "user_redeem",
    "user_refund",
    "cobi_redeem",
    "cobi_refund",
)
