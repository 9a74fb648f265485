"""Registration of ready-made queries and of the SQL each is checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from merchlake.session import tune
from merchlake.sources.testdata import SQL as SOURCE_SQL

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

# Common table expressions: name -> SELECT. They may use each other.
CTES: dict[str, str] = dict(SOURCE_SQL)


def query(name: str, sql: str | None = None):
    """Register a query; `sql` may use the names in CTES, which are put in front."""

    def register(build: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plain(build(tune(spark), sf_dir))

        run.__name__ = name
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = with_ctes(sql)
        return build

    return register


def with_ctes(sql: str) -> str:
    """Put the common table expressions a statement mentions (and theirs) in front of it."""
    needed: list[str] = []
    open_names: list[str] = []

    def visit(text: str) -> None:
        for name, body in CTES.items():
            if name not in needed and name not in open_names and _mentions(text, name):
                open_names.append(name)
                visit(body)
                needed.append(name)

    visit(sql)
    if not needed:
        return sql.strip()
    front = ",\n".join(f"{n} AS ({CTES[n].strip()})" for n in needed)
    return f"WITH {front}\n{sql.strip()}"


def _mentions(text: str, name: str) -> bool:
    padded = f" {text} "
    start = 0
    while (at := padded.find(name, start)) >= 0:
        before, after = padded[at - 1], padded[at + len(name)]
        if not (before.isalnum() or before in "_.\"'") and not (after.isalnum() or after in "_\"'"):
            return True
        start = at + 1
    return False


def plain(df: DataFrame) -> DataFrame:
    """Dates and times as text, whole numbers as BIGINT, text lists as one text: the same in every engine."""
    columns = []
    for field in df.schema:
        column, kind = F.col(f"`{field.name}`"), field.dataType
        if isinstance(kind, T.DateType):
            column = F.date_format(column, "yyyy-MM-dd")
        elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(kind, (T.IntegerType, T.ShortType, T.ByteType)):
            column = column.cast("bigint")
        elif isinstance(kind, T.FloatType):
            column = column.cast("double")
        elif isinstance(kind, T.ArrayType):
            column = F.array_join(column.cast("array<string>"), ",")
        columns.append(column.alias(field.name))
    return df.select(*columns)


def rounded(expression: str, digits: int = 2) -> str:
    """SQL twin of scalars.money."""
    return f"CAST(round(CAST({expression} AS DECIMAL(38,6)), {digits}) AS DOUBLE)"


def day(expression: str) -> str:
    return f"strftime(CAST({expression} AS DATE), '%Y-%m-%d')"


def moment(expression: str) -> str:
    return f"strftime(CAST({expression} AS TIMESTAMP), '%Y-%m-%d %H:%M:%S.%f')"
