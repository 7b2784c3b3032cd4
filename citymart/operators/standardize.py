"""Raw rows to typed tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citymart.functions import columns as C


@dataclass(frozen=True)
class Field:
    """One output column: where it comes from, its type and what replaces NULL.

    ``dirty`` marks text that may hold the missing-value sentinel.
    """

    source: str
    name: str
    dtype: str = "string"
    default: object = None
    dirty: bool = False

    def column(self) -> Column:
        value = F.col(self.source)
        if self.dirty:
            value = C.clean_number(value, self.dtype)
        if self.default is not None:
            return C.with_default(value, self.default, self.dtype).alias(self.name)
        return (value.cast if self.dtype == "string" else value.try_cast)(self.dtype).alias(self.name)


def standardize(df: DataFrame, fields: Sequence[Field], source_dataset: str | None = None) -> DataFrame:
    """Project, rename, default and cast in one select; tag the rows with their source."""
    tags = [] if source_dataset is None else [F.lit(source_dataset).alias("source_dataset")]
    return df.select(*[f.column() for f in fields], *tags)


def with_load_time(df: DataFrame) -> DataFrame:
    """Put the time of the load in front of the source tag."""
    return df.select(
        *[c for c in df.columns if c != "source_dataset"],
        F.current_timestamp().alias("load_timestamp"),
        "source_dataset",
    )


# Source columns, their names and types in the formatted tables, defaults for NULL.


def listing_fields(coordinate_default: float | None = 0.0) -> list[Field]:
    return [
        Field("propertyCode", "property_code"),
        Field("url", "property_url"),
        Field("district", "district"),
        Field("neighborhood", "neighborhood"),
        Field("address", "address"),
        Field("municipality", "municipality"),
        Field("latitude", "latitude", "double", coordinate_default),
        Field("longitude", "longitude", "double", coordinate_default),
        Field("propertyType", "property_type"),
        Field("detailedType", "detailed_type"),
        Field("size", "size_m2", "int", 0),
        Field("rooms", "rooms", "int", 0),
        Field("bathrooms", "bathrooms", "int", 0),
        Field("floor", "floor"),
        Field("status", "status"),
        Field("price", "price_eur", "double", 0.0),
        Field("priceByArea", "price_per_m2", "double", 0.0),
        Field("exterior", "is_exterior", "boolean", False),
        Field("hasLift", "has_lift", "boolean", False),
        Field("parkingSpace.hasParkingSpace", "has_parking", "boolean", False),
    ]


INCOME_FIELDS = [
    Field("Any", "year", "int", dirty=True),
    Field("Codi_Districte", "district_code", "int", dirty=True),
    Field("Nom_Districte", "district_name"),
    Field("Codi_Barri", "neighborhood_code", "int", dirty=True),
    Field("Nom_Barri", "neighborhood_name"),
    Field("`Població`", "population", "double", dirty=True),
    Field("`Índex RFD Barcelona = 100`", "income_index_bcn_100", "double", dirty=True),
]


def site_fields(coordinate_default: float | None = 0.0) -> list[Field]:
    return [
        Field("_id", "site_id"),
        Field("name", "facility_name"),
        Field("institution_name", "institution_name"),
        Field("addresses_district_id", "district_code", "int", dirty=True),
        Field("addresses_district_name", "district"),
        Field("addresses_neighborhood_name", "neighborhood"),
        Field("geo_epgs_4326_y", "latitude", "double", coordinate_default, dirty=True),
        Field("geo_epgs_4326_x", "longitude", "double", coordinate_default, dirty=True),
        Field("values_category", "category"),
        Field("values_value", "facility_type"),
    ]


def valid_listings(df: DataFrame) -> DataFrame:
    """Listings with a price, a size and a district, which is more than blanks: tables are stored by
    district, and an empty partition value would read back as NULL."""
    return df.filter((F.col("price_eur") > 0) & (F.col("size_m2") > 0) & (F.trim("district") != ""))


def format_listings(raw: DataFrame, coordinate_default: float | None = 0.0) -> DataFrame:
    """Listing records under the contract of the formatted table, invalid ones left out."""
    return with_load_time(valid_listings(standardize(raw, listing_fields(coordinate_default), "idealista")))


def format_income(raw: DataFrame) -> DataFrame:
    return with_load_time(standardize(raw, INCOME_FIELDS, "income"))


def format_sites(raw: DataFrame, coordinate_default: float | None = 0.0) -> DataFrame:
    formatted = standardize(raw, site_fields(coordinate_default), "cultural_sites")
    return with_load_time(formatted.dropna(subset=["site_id", "facility_name", "district"]))


def numeric_text(df: DataFrame, column: str, dtype: str = "int") -> DataFrame:
    """Rows whose text in ``column`` is all digits, with the column as a number."""
    return df.filter(C.all_digits(F.col(column))).withColumn(column, F.col(column).try_cast(dtype))


def fill_missing(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """NULLs replaced per column; a default is cast to the type of its column."""
    return df.withColumns(
        {c: F.coalesce(F.col(c), F.lit(v).cast(df.schema[c].dataType)) for c, v in defaults.items()}
    )


def all_known(columns: Sequence[str]) -> Column:
    """True where none of the columns is NULL."""
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
