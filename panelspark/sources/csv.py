"""CSV ingest for panels exported by public data portals.

The panels are published as CSV with a header row and many more columns than
the jobs use, in an order that changes between releases. The file is read
without schema inference (every field a string, one pass, no sampling job) and
the needed columns are then selected by header name and cast to the types the
jobs expect, so column pruning still applies and the column order of the file
does not matter.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_KEY = [
    T.StructField("continent", T.StringType()),
    T.StructField("location", T.StringType()),
    T.StructField("date", T.DateType()),
    T.StructField("population", T.LongType()),
]

DEATHS_SCHEMA = T.StructType(_KEY + [
    T.StructField("total_cases", T.LongType()),
    T.StructField("new_cases", T.LongType()),
    T.StructField("total_deaths", T.LongType()),
    T.StructField("new_deaths", T.LongType()),
    T.StructField("new_deaths_per_million", T.DoubleType()),
    T.StructField("total_deaths_per_million", T.DoubleType()),
])

VAX_SCHEMA = T.StructType(_KEY + [
    T.StructField("total_vaccinations", T.LongType()),
    T.StructField("people_vaccinated", T.LongType()),
    T.StructField("people_fully_vaccinated", T.LongType()),
    T.StructField("total_boosters", T.LongType()),
    T.StructField("new_vaccinations", T.LongType()),
    T.StructField("people_fully_vaccinated_per_hundred", T.DoubleType()),
    T.StructField("total_boosters_per_hundred", T.DoubleType()),
    T.StructField("gdp_per_capita", T.DoubleType()),
    T.StructField("human_development_index", T.DoubleType()),
])


def read_panel_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read a panel CSV (header row, ISO dates, empty field = NULL)."""
    raw = spark.read.option("header", True).option("inferSchema", False).csv(path)
    return raw.select(*[_typed(f) for f in schema.fields])


def _typed(field: T.StructField):
    col = F.col(f"`{field.name}`")
    if isinstance(field.dataType, T.LongType):
        # Portals write counts as "123.0"; go through double so ANSI casts accept it.
        col = col.cast("double")
    return col.cast(field.dataType).alias(field.name)


def read_panel_csv_checked(
    spark: SparkSession, path: str, schema: T.StructType, header: Sequence[str] | None = None,
    required: Sequence[str] = ("location", "date"),
) -> DataFrame:
    """The panel CSV with each row's ``problem`` and ``raw`` line instead of errors or silent NULLs.

    ``problem`` is NULL for a sound row. Otherwise it is ``malformed`` (another number of fields than the
    header, or broken quotes), ``missing <column>`` for an empty ``required`` column, or
    ``invalid <column>`` for the first column, in the order of ``schema``, whose text is no value of its type;
    counts may be written as "123.0", but not as "123.5". ``raw`` is the line of a malformed row,
    and for the others the fields that were read, joined by commas.
    Typed columns of a row with a problem hold what could be read.

    ``header`` names the columns of files that have no header row. The sound rows are
    ``where("problem IS NULL")``; nothing is dropped, in one pass over the files.
    """
    if header is None:
        header = spark.read.option("header", True).option("inferSchema", False).csv(path).columns
        reader = spark.read.option("header", True)
    else:
        reader = spark.read.option("header", False)
    corrupt = "_corrupt_record"
    text = T.StructType([T.StructField(c, T.StringType()) for c in (*header, corrupt)])
    lines = (
        reader.schema(text).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", corrupt).csv(path)
    )
    problem = F.when(F.col(corrupt).isNotNull(), F.lit("malformed"))
    for name in required:
        problem = problem.when(F.col(f"`{name}`").isNull(), F.lit(f"missing {name}"))
    for field in schema.fields:
        source = F.col(f"`{field.name}`")
        problem = problem.when(source.isNotNull() & _tried(field).isNull(), F.lit(f"invalid {field.name}"))
    joined = F.concat_ws(",", *[F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in header])
    return lines.select(
        *[_tried(f).alias(f.name) for f in schema.fields],
        problem.alias("problem"),
        F.coalesce(F.col(corrupt), joined).alias("raw"),
    )


def _tried(field: T.StructField):
    """The value of a text column, NULL where the text is none of its type."""
    col = F.col(f"`{field.name}`")
    if isinstance(field.dataType, T.LongType):
        number = col.try_cast("decimal(38,6)")
        return F.when(number == F.floor(number), number).try_cast("long")
    return col.try_cast(field.dataType)
