"""Code lists of the fare-card domain and expressions over them."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Subway codes 200-299, and the further codes that count as
# subway outside the metropolitan area.
SUBWAY_CODES = (200, 299)
REGIONAL_SUBWAY_CODES = {
    "metropolitan": (),
    "chungcheong": (440, 699, 547, 552, 850, 851, 852, 853, 870, 871, 872, 877),
    "gyeongsang": (440, 619, 699, 547, 552, 850, 851, 852, 853, 870, 871, 872, 877),
    "jeju": (),
    "jeolla": (4, 440, 699, 547, 552, 850, 851, 852, 853, 870, 871, 872, 877),
}

# The general adult user type and the purpose labels.
ADULT = 1
PURPOSE_NAMES = {"morning": "출근", "evening": "퇴근"}


def mode_of(code: Column, extra: tuple[int, ...] = ()) -> Column:
    """``T`` for subway codes, ``B`` for everything else and NULL."""
    subway = code.between(*SUBWAY_CODES)
    if extra:
        subway = subway | code.isin(*extra)
    return F.when(subway, F.lit("T")).otherwise(F.lit("B"))


def purpose_name(trip_type: Column) -> Column:
    label = None
    for key, name in PURPOSE_NAMES.items():
        test = trip_type == key
        label = F.when(test, name) if label is None else label.when(test, name)
    return label
