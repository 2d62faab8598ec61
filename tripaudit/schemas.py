"""Declared input schemas, reduced to the columns the operators touch.

Kept as text, because parsing a schema needs a running session. The daily
extracts of a deployment have more columns; pass their full declaration to
:func:`schema_from_ddl` and hand the result to the TSV reader.
"""

from __future__ import annotations

from pyspark.sql.types import StructType


def declared_columns(text: str) -> list[tuple[str, str]]:
    """(name, type) of each declared column.

    One column per line; blank lines are skipped and words after the type are
    comments.
    """
    return [tuple(line.split()[:2]) for line in text.splitlines() if len(line.split()) >= 2]


def schema_from_ddl(text: str) -> StructType:
    """Parse declared ``name type`` lines into a schema; needs a running session.

    Every declared type is honoured, so a value is cast to the type its column
    was declared with and never stays text by accident.
    """
    return StructType.fromDDL(", ".join(f"`{name}` {kind}" for name, kind in declared_columns(text)))


# Columns of the order and extension extracts that the operators touch.
ORDER = """
    service_order_id bigint
    city string
    status int
    passenger_name string
    driver_id bigint
    arrival_time bigint
    start_time bigint
    end_time bigint
    start_longitude double
    start_latitude double
    expect_start_longitude double
    expect_start_latitude double
    expect_end_longitude double
    actual_time_length int
    dependable_distance int
    system_distance int
    update_time bigint
    dt int
"""

ORDER_EXT = """
    service_order_id bigint
    driver_version string
    runtime int
    estimate_snap string
    update_time bigint
    dt int
"""

# Column order of the device and risk-list extracts.
DEVICE = """
    device_id bigint
    user_id bigint
    status int
    user_type string
    update_time int
    app_version string
    os_type string
    os_version string
    mac_address string
    device_type string
    device_serialno string
    exception_flag int
    os_name string
    app_series int
    dt int
"""

RISK_ORDER = """
    service_order_id bigint
    city string
    driver_id bigint
    user_id bigint
    price double
    create_time timestamp_ntz
    complete_time timestamp_ntz
    car_type string
    company string
    product_type string
    charge_distance double
    charge_time_length double
    system_distance double
    mileage double
    actual_time_length double
    is_rc string
"""

TRACK_POINT = """
    timestamp bigint
    provider string
    accuracy double
    latitude double
    longitude double
"""

DRIVER_ORDER_HIST = """
    dt int
    driver_id bigint
    zero_cnt bigint
    total_cnt bigint
"""
