"""Column expressions of the event record and the silver layer.

Arguments are column names or SQL expressions chosen by the calling code, never
values from outside.
"""

from pyspark.sql import functions as F

from playlens.schemas import PERCENT, SCORE

# Weekday names, Monday first.
WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")

_PERCENT, _SCORE = PERCENT.simpleString(), SCORE.simpleString()


def _flag(condition):
    """1 where the condition holds, 0 where it is false or NULL."""
    return F.expr(f"CASE WHEN {condition} THEN 1 ELSE 0 END")


def pick(values, position):
    """The value at a zero-based position of a short list."""
    listed = ", ".join(repr(v) for v in values)
    return F.expr(f"element_at(array({listed}), int({position}) + 1)")


def calendar_features(ts):
    """Hour, weekday name, month, prime-time and weekend flags of a timestamp."""
    return {
        "event_hour": F.expr(f"hour({ts})"),
        # A lookup is about twice as fast as formatting the date.
        "event_day": pick(WEEKDAYS, f"weekday({ts})"),
        "event_month": F.expr(f"month({ts})"),
        "is_prime_time": _flag(f"hour({ts}) BETWEEN 18 AND 23"),
        "is_weekend": _flag(f"weekday({ts}) >= 5"),
    }


def completion_pct(watched, total):
    """Watched share in percent, two places; NULL for total 0.

    Computed in binary floating point with ties to the even digit, as producers do:
    another way of rounding would move some events by a hundredth.
    """
    share = f"try_divide(double({watched}), double({total})) * 100"
    return F.expr(f"try_cast(bround({share}, 2) AS {_PERCENT})")


def is_completed(pct):
    return _flag(f"{pct} >= 90")


def is_dropped(pct):
    return _flag(f"{pct} < 10")


def completion_category(pct):
    """COMPLETED from 90, MAJORITY from 50, else (also NULL) PARTIAL."""
    return F.expr(f"CASE WHEN {pct} >= 90 THEN 'COMPLETED' WHEN {pct} >= 50 THEN 'MAJORITY' "
                  "ELSE 'PARTIAL' END")


def device_category(device_type):
    """Group of an upper-cased device type; unknown and NULL devices count as DESKTOP."""
    return F.expr(f"CASE WHEN {device_type} IN ('MOBILE', 'TABLET') THEN 'MOBILE' "
                  f"WHEN {device_type} IN ('SMARTTV', 'ROKU') THEN 'TV' ELSE 'DESKTOP' END")


def tidy_upper(c):
    return F.expr(f"trim(upper({c}))")


def parse_time(c):
    """Text with or without ``T`` to a timestamp; unreadable text becomes NULL."""
    return F.expr(f"try_to_timestamp({c})")


# The next three are our own definitions: the reports read these columns, but no
# published formula exists for them.

def time_of_day(ts):
    return F.expr(f"CASE WHEN hour({ts}) BETWEEN 5 AND 11 THEN 'MORNING' "
                  f"WHEN hour({ts}) BETWEEN 12 AND 17 THEN 'AFTERNOON' "
                  f"WHEN hour({ts}) BETWEEN 18 AND 23 THEN 'EVENING' ELSE 'NIGHT' END")


def engagement_score(pct):
    """70 % of the completion plus 30 points for a completed view."""
    pct = f"cast({pct} AS {_PERCENT})"
    return F.expr(f"cast({pct} * 0.7 + CASE WHEN {pct} >= 90 THEN 30 ELSE 0 END AS {_SCORE})")


def revenue_per_view(price, pct):
    """Share of the subscription price that matches the watched share."""
    return F.expr(f"cast(cast({price} AS {_PERCENT}) * cast({pct} AS {_PERCENT}) / 100 "
                  f"AS {_SCORE})")
