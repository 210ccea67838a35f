"""What a fact table must look like: column classes, roles and derived columns."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class Role:
    """One use of the dimension: a fact key and the two columns it brings in."""

    key: str
    borough: str
    zone: str


@dataclass(frozen=True)
class FactContract:
    """Column layout of a fact table, from raw input to finished output.

    ``columns`` gives the order; every column is in exactly one of
    ``integers``, ``floats`` and ``times``. Two rows are the same row when all
    of ``columns`` agree.
    """

    name: str
    columns: tuple[str, ...]
    integers: tuple[str, ...]
    floats: tuple[str, ...]
    times: tuple[str, ...]
    start: str
    end: str
    distance: str
    roles: tuple[Role, ...]
    duration: str = "duration_seconds"
    hour: str = "start_hour"
    speed: str = "speed"

    def __post_init__(self) -> None:
        classed = [*self.integers, *self.floats, *self.times]
        if sorted(classed) != sorted(self.columns):
            raise ValueError("Each column must be in exactly one of integers, floats and times.")

    @property
    def zone_columns(self) -> list[str]:
        return [name for role in self.roles for name in (role.borough, role.zone)]

    @property
    def output_columns(self) -> list[str]:
        return [*self.columns, *self.zone_columns, self.duration, self.hour, self.speed]

    def clean_type(self, column: str) -> T.DataType:
        if column in self.integers:
            return T.LongType()
        return T.TimestampNTZType() if column in self.times else T.DoubleType()

    def clean_schema(self) -> T.StructType:
        return T.StructType([T.StructField(c, self.clean_type(c)) for c in self.columns])

    def staging_schema(self) -> T.StructType:
        return T.StructType(
            [*self.clean_schema().fields, T.StructField("_key", T.LongType()), T.StructField("_bucket", T.IntegerType())]
        )

    def output_schema(self) -> T.StructType:
        return T.StructType(
            [
                *self.clean_schema().fields,
                *[T.StructField(c, T.StringType()) for c in self.zone_columns],
                T.StructField(self.duration, T.DoubleType()),
                T.StructField(self.hour, T.LongType()),
                T.StructField(self.speed, T.DoubleType()),
            ]
        )


# Column names of the public yellow-cab trip files and of the finished output.
TRIPS = FactContract(
    name="trips-v1",
    columns=(
        "VendorID",
        "tpep_pickup_datetime",
        "tpep_dropoff_datetime",
        "passenger_count",
        "trip_distance",
        "PULocationID",
        "DOLocationID",
        "fare_amount",
        "total_amount",
    ),
    integers=("VendorID", "passenger_count", "PULocationID", "DOLocationID"),
    floats=("trip_distance", "fare_amount", "total_amount"),
    times=("tpep_pickup_datetime", "tpep_dropoff_datetime"),
    start="tpep_pickup_datetime",
    end="tpep_dropoff_datetime",
    distance="trip_distance",
    roles=(
        Role("PULocationID", "pickup_borough", "pickup_zone"),
        Role("DOLocationID", "dropoff_borough", "dropoff_zone"),
    ),
    hour="pickup_hour",
    speed="average_speed_mph",
)

# The same contract under neutral names; the star-schema views use it.
MOVES = FactContract(
    name="moves-v1",
    columns=("vendor_id", "start_ts", "end_ts", "party_size", "distance", "from_id", "to_id", "fare", "total"),
    integers=("vendor_id", "party_size", "from_id", "to_id"),
    floats=("distance", "fare", "total"),
    times=("start_ts", "end_ts"),
    start="start_ts",
    end="end_ts",
    distance="distance",
    roles=(Role("from_id", "from_borough", "from_zone"), Role("to_id", "to_borough", "to_zone")),
)
