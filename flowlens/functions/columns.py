"""Column expressions: cleaning, derived measures, bands.

Everything here is a Catalyst expression, so it stays inside whole-stage code
generation; there is no Python UDF in the package.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from flowlens.schema import NORMAL

UTC_EPOCH = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---- labels -------------------------------------------------------------

def attack_name(c: Column | str, null_as_normal: bool = True) -> Column:
    """Trimmed class name with the plural spelling of Backdoor folded in.

    With ``null_as_normal`` a missing or blank class is benign; without it the
    value is kept as it came (for exploration).
    """
    tidy = F.replace(F.trim(_col(c)), F.lit("Backdoors"), F.lit("Backdoor"))
    return F.coalesce(F.nullif(tidy, F.lit("")), F.lit(NORMAL)) if null_as_normal else tidy


def is_attack(c: Column | str = "attack_cat") -> Column:
    """1 when the class is known and not benign, else 0."""
    return (~_col(c).eqNullSafe(F.lit(NORMAL))).cast("int")


# ---- numbers ------------------------------------------------------------

def to_double(c: Column | str, default: float | None = 0.0) -> Column:
    """Number from free-form text; anything unreadable becomes ``default``."""
    parsed = _col(c).try_cast("double")
    return parsed if default is None else F.coalesce(parsed, F.lit(default))


def to_int(c: Column | str) -> Column:
    """Integer from free-form text; blanks and junk become NULL."""
    return _col(c).try_cast("int")


def bytes_ratio(sent: Column | str = "sbytes", received: Column | str = "dbytes") -> Column:
    """Bytes sent per byte received, 0 when nothing was received."""
    s, r = _col(sent), _col(received)
    return F.when(r == 0, F.lit(0.0)).otherwise(s / r)


def relative_deviation(value: Column | str, usual: Column | str) -> Column:
    return F.abs(_col(value) - _col(usual)) / (_col(usual) + F.lit(1))


def threat_score(
    sbytes: Column | str = "sbytes",
    usual_sbytes: Column | str = "avg_sbytes_proto",
    sload: Column | str = "sload",
    usual_sload: Column | str = "avg_sload_proto",
) -> Column:
    """Mean relative deviation of bytes and load from the protocol's usual.

    A missing input makes the deviation NULL, which counts as score 0.
    """
    half = F.lit(0.5)
    return F.coalesce(
        relative_deviation(sbytes, usual_sbytes) * half
        + relative_deviation(sload, usual_sload) * half,
        F.lit(0.0),
    )


def same_endpoint() -> Column:
    """1 when source and destination share address and port."""
    same = (F.col("srcip") == F.col("dstip")) & (F.col("sport") == F.col("dsport"))
    return F.coalesce(same, F.lit(False)).cast("int")


def handshake_time() -> Column:
    """TCP set-up round trip: SYN to SYN_ACK plus SYN_ACK to ACK."""
    return F.col("synack") + F.col("ackdat")


# ---- time ---------------------------------------------------------------

def event_time(epoch_seconds: Column | str = "stime") -> Column:
    """Instant of an epoch-seconds column."""
    return F.timestamp_seconds(_col(epoch_seconds).cast("long"))


def utc_clock(epoch_seconds: Column | str) -> Column:
    """UTC wall-clock time of an epoch-seconds column, whatever the session zone."""
    return F.timestamp_add("SECOND", _col(epoch_seconds).cast("long"), F.expr(UTC_EPOCH))


def utc_epoch(clock: Column | str) -> Column:
    """Epoch seconds of a UTC wall-clock (zone-free) timestamp."""
    return F.timestamp_diff("SECOND", F.expr(UTC_EPOCH), _col(clock))


def utc_instant(clock: Column | str) -> Column:
    """Instant of a UTC wall-clock (zone-free) timestamp, as streams need it."""
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", F.expr(UTC_EPOCH), _col(clock)))


def instant_clock(instant: Column | str) -> Column:
    """UTC wall-clock time of an instant, whatever the session zone."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(_col(instant)), F.expr(UTC_EPOCH))


# ---- bands --------------------------------------------------------------

def confidence_band(c: Column | str = "confidence") -> Column:
    v = _col(c)
    return F.when(v >= 0.8, "High").when(v >= 0.5, "Medium").otherwise("Low")


def severity_band(c: Column | str = "threat_score") -> Column:
    v = _col(c)
    return F.when(v >= 80, "critical").when(v >= 50, "warning").otherwise("low")


# Edges and names of the threat bands; the last edge is exclusive.
THREAT_EDGES = [0, 40, 70, 90, 101]
THREAT_NAMES = ["Low", "Medium", "High", "Critical"]
# Upper ends of the ten-wide and the twenty-wide bands.
DECILE_UPPER = [10, 20, 30, 40, 50, 60, 70, 80, 90, 100]
TWENTY_UPPER = [20, 40, 60, 80, 100]


def threat_bucket(c: Column | str = "threat_score", edges: list[int] = THREAT_EDGES,
                  names: list[str] = THREAT_NAMES) -> Column:
    """Half-open band ``[edge, next)`` as text; NULL or outside is ``Unknown``."""
    v = _col(c)
    out = F.lit("Unknown")
    for low, high, name in reversed(list(zip(edges, edges[1:], names))):
        out = F.when((v >= low) & (v < high), F.lit(f"[{low},{high}) {name}")).otherwise(out)
    return out


def upper_bound_bucket(c: Column | str, uppers: list[int]) -> Column:
    """Closed band ``low-high`` by its upper ends (0-10, 11-20, …), else ``Unknown``."""
    v = _col(c)
    out = F.lit("Unknown")
    lows = [0] + [u + 1 for u in uppers[:-1]]
    floor = [-1] + uppers[:-1]
    for below, low, high in reversed(list(zip(floor, lows, uppers))):
        out = F.when((v > below) & (v <= high), F.lit(f"{low}-{high}")).otherwise(out)
    return out


# ---- alert fields of a prediction --------------------------------------

def alert_confidence(attack_probability: Column | str) -> Column:
    """Probability of the chosen side, four digits."""
    p = _col(attack_probability)
    return F.round(F.when(p >= 0.5, p).otherwise(F.lit(1.0) - p), 4)


def alert_threat_score(attack_probability: Column | str) -> Column:
    """Whole-number score 0-100 of an attack, 0 for benign traffic."""
    p = _col(attack_probability)
    return F.when(p >= 0.5, F.least(p * 100, F.lit(100.0)).cast("int")).otherwise(F.lit(0))
