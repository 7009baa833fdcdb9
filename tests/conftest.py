from __future__ import annotations

import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tapflow.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session(8, "tapflow-tests")


def at(text: str) -> dt.datetime:
    return dt.datetime.strptime(text, "%Y-%m-%d %H:%M:%S")


TAP_DDL = """op_date date, card_id string, txn_id string, transfer_no int, region_code string, mode_code int, user_type int,
  board_stop bigint, board_ts timestamp_ntz, alight_stop bigint, alight_ts timestamp_ntz, distance double, ride_sec double"""


def leg(card="c", txn="1", no=0, board=1, b="2025-01-06 08:00:00", alight=2, a="2025-01-06 08:20:00", **over):
    """One leg with defaults."""
    row = {
        "op_date": dt.date(2025, 1, 6),
        "card_id": card,
        "txn_id": txn,
        "transfer_no": no,
        "region_code": "R0",
        "mode_code": 201,
        "user_type": 1,
        "board_stop": board,
        "board_ts": at(b) if b else None,
        "alight_stop": alight,
        "alight_ts": at(a) if a else None,
        "distance": 1000.0,
        "ride_sec": 1200.0,
    }
    row.update(over)
    return tuple(row.values())


TRIP_DDL = """op_date date, card_id string, txn_id string, board_stop bigint, alight_stop bigint, board_ts timestamp_ntz,
  alight_ts timestamp_ntz, board_region string, alight_region string, board_mode string, alight_mode string,
  total_distance double, total_ride_sec double, max_transfers int"""


def trip(card, board, alight, b, a, txn="1", day=None):
    board_ts, alight_ts = at(b), at(a)
    return (
        day or board_ts.date(), card, txn, board, alight, board_ts, alight_ts,
        "R0", "R0", "T", "T", 5000.0, 1200.0, 0,
    )
