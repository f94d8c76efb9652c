from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from acreage.operators.events import select_event
from acreage.plans import views
from acreage.plans.jobs import PENDING_EVENT, RENTAL_EVENT, SALE_EVENT
from acreage.plans.registry import plain, query

COLUMNS = {"kind": "event_type", "name": "event_name", "day": "event_ts", "price": "price", "tie": "event_id"}
SHOWN = ["parcl_property_id", "event_day", "event_id", "event_type", "event_name", "price"]
SHOWN_SQL = """SELECT parcl_property_id, CAST(event_day AS VARCHAR) AS event_day, event_id, event_type,
                      event_name, price FROM"""


@query(
    views.sql_with(
        "parcel_event",
        then=f""", ranked AS (
            SELECT *, CASE WHEN event_type = 'SALE' THEN 1 ELSE 2 END AS choice,
                   CASE WHEN event_type = 'SALE'
                        THEN ROW_NUMBER() OVER (PARTITION BY parcl_property_id, event_day, event_type
                                                ORDER BY event_ts DESC, event_id)
                        ELSE ROW_NUMBER() OVER (PARTITION BY parcl_property_id, event_day, event_type
                                                ORDER BY event_ts, event_id DESC) END AS place
            FROM parcel_event
            WHERE (event_type = 'SALE' AND event_name = 'SOLD' AND price > 0)
               OR (event_type = 'LISTING' AND event_name = 'PENDING SALE')),
        best AS (SELECT *, MIN(choice) OVER (PARTITION BY parcl_property_id, event_day) AS wanted FROM ranked)
        {SHOWN_SQL} best WHERE place = 1 AND choice = wanted""",
    )
)
def valid_event_selection(spark: SparkSession, folder: str) -> DataFrame:
    events = views.parcel_events(spark, folder)
    chosen = select_event(events, ["parcl_property_id", "event_day"], SALE_EVENT, PENDING_EVENT, **COLUMNS)
    return plain(chosen.select(*SHOWN))


@query(
    views.sql_with(
        "parcel_event",
        then=f"""{SHOWN_SQL} (SELECT *, ROW_NUMBER() OVER (PARTITION BY parcl_property_id, event_day
                                                         ORDER BY event_ts DESC, event_id) AS place
                  FROM parcel_event
                  WHERE event_type = 'RENTAL' AND event_name = 'DELISTED FOR RENT' AND price > 0)
            WHERE place = 1""",
    )
)
def rental_event_selection(spark: SparkSession, folder: str) -> DataFrame:
    events = views.parcel_events(spark, folder)
    chosen = select_event(events, ["parcl_property_id", "event_day"], RENTAL_EVENT, **COLUMNS)
    return plain(chosen.select(*SHOWN))
