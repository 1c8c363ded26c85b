"""Record and table schemas, and the fixed values the results depend on."""

from pyspark.sql import types as T

ACTIVITY = T.StructType(
    [
        T.StructField("is_arrival", T.BooleanType()),
        T.StructField("location", T.StringType()),
        T.StructField("event_time", T.TimestampType()),
        T.StructField("truck_id", T.IntegerType()),
        T.StructField("package_id", T.StringType()),
    ]
)

PACKAGE_TABLE = T.StructType(
    [
        T.StructField("packageId", T.StringType()),
        T.StructField("location", T.StringType()),
        T.StructField("truckId", T.IntegerType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)

COUNT_TABLE = T.StructType(
    [
        T.StructField("location", T.StringType()),
        T.StructField("count", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)

# They must be exactly these for the results to be right.
LEGACY_LOCATION = "AR"
VIP_PREFIX = "VIP"
NEW_TRUCK_THRESHOLD = 200
ACTIVITY_TEXT = ("PackageActivityInfo [isArrival=", ", location=", ", packageId=", "]")
REPORT_LOCATION = "Location: "
REPORT_CALLS = "Total # Support Calls: "
REPORT_ARRIVED = "Arrived: "
REPORT_DEPARTED = "Departed: "
REPORT_END = "End "
REPORT_HEADER_STARS = 10
REPORT_FOOTER_STARS = 6
