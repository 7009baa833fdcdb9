"""Table schemas and load contracts."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# Header names of the published fare-card extracts.
TAP_HEADERS = {
    "운행일자": "op_date",
    "정산사ID": "operator_id",
    "가상카드번호": "card_id",
    "정산지역코드": "region_code",
    "카드구분코드": "card_kind",
    "정산사차량ID": "vehicle_id",
    "교통수단코드": "mode_code",
    "정산사노선ID": "route_id",
    "승차일시": "board_ts",
    "정산사승차정류장ID": "board_stop",
    "하차일시": "alight_ts",
    "정산사하차정류장ID": "alight_stop",
    "트랜잭션ID": "txn_id",
    "환승건수": "transfer_no",
    "이용자유형코드(시스템)": "user_type",
    "이용자수": "riders",
    "이용거리": "distance",
    "탑승시간": "ride_sec",
}



# Ids and times arrive as text so that a malformed cell becomes NULL on the
# guarded cast instead of failing the scan.
TAPS_TEXT = T.StructType(
    [
        T.StructField(name, kind)
        for name, kind in [
            ("op_date", T.StringType()),
            ("operator_id", T.StringType()),
            ("card_id", T.StringType()),
            ("region_code", T.StringType()),
            ("card_kind", T.StringType()),
            ("vehicle_id", T.StringType()),
            ("mode_code", T.IntegerType()),
            ("route_id", T.StringType()),
            ("board_ts", T.StringType()),
            ("board_stop", T.StringType()),
            ("alight_ts", T.StringType()),
            ("alight_stop", T.StringType()),
            ("txn_id", T.StringType()),
            ("transfer_no", T.IntegerType()),
            ("user_type", T.IntegerType()),
            ("riders", T.IntegerType()),
            ("distance", T.DoubleType()),
            ("ride_sec", T.DoubleType()),
        ]
    ]
)

STOPS_TEXT = T.StructType(
    [
        T.StructField("stop_id", T.StringType()),
        T.StructField("region_code", T.StringType()),
        T.StructField("mode", T.StringType()),
        T.StructField("stop_name", T.StringType()),
        T.StructField("legal_dong", T.StringType()),
        T.StructField("gps_x", T.DoubleType()),
        T.StructField("gps_y", T.DoubleType()),
    ]
)

STOP_KEY = ["stop_id", "region_code", "mode"]
TRIP_KEY = ["op_date", "card_id", "txn_id"]
OD_KEY = [
    "board_stop",
    "board_region",
    "board_mode",
    "alight_stop",
    "alight_region",
    "alight_mode",
]

# Columns, key and field sizes of the published table.
PUBLISHED_OD_COLUMNS = [
    "standard_ym",
    "departure_station_id",
    "departure_station_name",
    "departure_region_code",
    "departure_station_type",
    "departure_grid_id",
    "arrival_station_id",
    "arrival_station_name",
    "arrival_region_code",
    "arrival_station_type",
    "arrival_grid_id",
    "purpose_name",
    "daily_use_count",
    "median_elapse_time",
    "average_elapse_time",
    "median_distance",
    "average_distance",
    "departure_station_geometry",
    "arrival_station_geometry",
]


@dataclass(frozen=True)
class Contract:
    """What a load target demands of each row."""

    lengths: dict[str, int] = field(default_factory=dict)
    numerics: dict[str, tuple[int, int]] = field(default_factory=dict)
    required: tuple[str, ...] = ()
    key: tuple[str, ...] = ()


OD_LOAD_KEY = (
    "standard_ym",
    "departure_station_id",
    "departure_region_code",
    "departure_station_type",
    "arrival_station_id",
    "arrival_region_code",
    "arrival_station_type",
    "purpose_name",
)

OD_LOAD = Contract(
    lengths={
        "standard_ym": 6,
        "departure_station_id": 20,
        "departure_station_name": 100,
        "departure_region_code": 20,
        "departure_station_type": 1,
        "departure_grid_id": 12,
        "arrival_station_id": 20,
        "arrival_station_name": 100,
        "arrival_region_code": 20,
        "arrival_station_type": 1,
        "arrival_grid_id": 12,
        "purpose_name": 2,
    },
    numerics={
        "daily_use_count": (10, 1),
        "median_elapse_time": (6, 0),
        "average_elapse_time": (6, 0),
        "median_distance": (6, 0),
        "average_distance": (6, 0),
    },
    required=OD_LOAD_KEY,
    key=OD_LOAD_KEY,
)


# Columns, key and field sizes of the daily table.
PUBLISHED_DAILY_COLUMNS = [
    "standard_date",
    "hour",
    "departure_station_id",
    "departure_station_name",
    "departure_region_code",
    "departure_station_type",
    "departure_grid_id",
    "arrival_station_id",
    "arrival_station_name",
    "arrival_region_code",
    "arrival_station_type",
    "arrival_grid_id",
    "trip_type",
    "use_count",
    "unique_use_count",
    "median_elapse_time",
    "average_elapse_time",
    "median_distance",
    "average_distance",
    "median_transfer_count",
    "average_transfer_count",
    "departure_station_geometry",
    "arrival_station_geometry",
]

DAILY_LOAD_KEY = ("standard_date", "hour", *OD_LOAD_KEY[1:-1], "trip_type")

DAILY_LOAD = Contract(
    lengths={"hour": 2, "trip_type": 2, **{c: n for c, n in OD_LOAD.lengths.items() if c.startswith(("departure", "arrival"))}}
    | {"departure_station_type": 2, "arrival_station_type": 2},
    numerics={
        "use_count": (10, 0),
        "unique_use_count": (10, 0),
        **{f"{kind}_{what}": (6, scale) for what, scale in (("elapse_time", 0), ("distance", 0), ("transfer_count", 1)) for kind in ("median", "average")},
    },
    required=DAILY_LOAD_KEY,
    key=DAILY_LOAD_KEY,
)
