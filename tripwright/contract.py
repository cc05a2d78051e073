"""Column contracts: a fixed target schema laid over sources whose schemas drift."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


class ContractError(ValueError):
    """A source cannot be brought into the shape the contract asks for."""


@dataclass(frozen=True)
class Field:
    name: str
    type: T.DataType
    required: bool = False


@dataclass(frozen=True)
class Contract:
    """Ordered columns with their types; the required ones must exist and be filled."""

    fields: tuple[Field, ...]

    @classmethod
    def of(cls, types: dict[str, T.DataType], required: Iterable[str] = ()) -> Contract:
        required = set(required)
        unknown = required - set(types)
        if unknown:
            raise ContractError(f"required columns outside the contract: {sorted(unknown)}")
        return cls(tuple(Field(n, t, n in required) for n, t in types.items()))

    @property
    def names(self) -> list[str]:
        return [f.name for f in self.fields]

    @property
    def required(self) -> list[str]:
        return [f.name for f in self.fields if f.required]

    def check_columns(self, columns: Iterable[str], where: str) -> None:
        """Raise if names clash by case or a required column is absent."""
        seen: dict[str, str] = {}
        for name in columns:
            other = seen.setdefault(name.lower(), name)
            if other is not name:
                raise ContractError(f"{where}: columns {other!r} and {name!r} differ only by case")
        absent = [n for n in self.required if n.lower() not in seen]
        if absent:
            raise ContractError(f"{where}: required columns are missing: {absent}")

    def project(self, df: DataFrame, where: str = "input") -> DataFrame:
        """Contract columns in contract order: matched by case-blind name, cast, renamed.

        A value that does not fit the target type becomes null, and an optional column the
        source lacks becomes a typed null, so every source yields the same schema.
        """
        self.check_columns(df.columns, where)
        lowered = df.toDF(*[c.lower() for c in df.columns])
        types = {f.name: f.dataType for f in lowered.schema}
        return lowered.select([self._column(f, types.get(f.name.lower())) for f in self.fields])

    @staticmethod
    def _column(field: Field, found: T.DataType | None) -> Column:
        if found is None:
            return F.lit(None).cast(field.type).alias(field.name)
        column = F.col(f"`{field.name.lower()}`")
        # An equal type passes through bare, which keeps filters on it pushable to the scan.
        if found != field.type:
            column = column.try_cast(field.type)
        return column.alias(field.name)


# The trip columns, their types, and which of them must be filled.
TRIPS = Contract.of(
    {
        "VendorID": T.LongType(),
        "tpep_pickup_datetime": T.TimestampType(),
        "tpep_dropoff_datetime": T.TimestampType(),
        "passenger_count": T.DoubleType(),
        "trip_distance": T.DoubleType(),
        "PULocationID": T.LongType(),
        "DOLocationID": T.LongType(),
        "payment_type": T.LongType(),
        "fare_amount": T.DoubleType(),
        "total_amount": T.DoubleType(),
    },
    required=[
        "tpep_pickup_datetime",
        "tpep_dropoff_datetime",
        "trip_distance",
        "PULocationID",
        "DOLocationID",
    ],
)

# The zone columns in use.
ZONES = Contract.of(
    {"LocationID": T.LongType(), "Borough": T.StringType(), "Zone": T.StringType()},
    required=["LocationID", "Borough", "Zone"],
)

# The columns that identify a trip when copies are removed by key.
TRIP_KEYS = (
    "tpep_pickup_datetime",
    "tpep_dropoff_datetime",
    "PULocationID",
    "DOLocationID",
    "trip_distance",
)

# The exported columns of an enriched trip.
EXPORT_COLUMNS = (
    "pickup_ts",
    "dropoff_ts",
    "trip_distance",
    "trip_duration_s",
    "PULocationID",
    "Borough",
    "Zone",
    "avg_speed_mph",
    "pickup_hour",
)

# Key and value columns of the speed summary.
GROUP_KEYS = ("pickup_hour", "Borough")
SUMMARY_COLUMNS = (*GROUP_KEYS, "mean_speed_mph", "trip_count")
