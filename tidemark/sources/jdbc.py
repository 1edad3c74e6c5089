"""Reading source tables from MySQL or PostgreSQL."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from pyspark.sql import DataFrame, SparkSession

# Driver names, default ports, wait for a connection.
DIALECTS = {"mysql": "mysql", "postgres": "postgresql", "postgresql": "postgresql"}
DEFAULT_PORTS = {"mysql": 3306, "postgresql": 5432}
DRIVER_CLASSES = {"mysql": "com.mysql.cj.jdbc.Driver", "postgresql": "org.postgresql.Driver"}
CONNECT_TIMEOUT_SECONDS = 15
FETCH_ROWS = 10_000
# A hash of a column as a number that is not negative.
HASHES = {"mysql": "CRC32({column})", "postgresql": "ABS(HASHTEXT(CAST({column} AS TEXT))::BIGINT)"}
ROWS_PER_TASK = 500_000


@dataclass(frozen=True)
class JdbcSource:
    driver: str
    host: str
    database: str
    user: str
    password: str
    port: int | None = None

    @property
    def dialect(self) -> str:
        name = self.driver.lower().strip()
        if name not in DIALECTS:
            raise ValueError(f"no address is known for databases of kind {self.driver!r}, only for {sorted(set(DIALECTS.values()))}")
        return DIALECTS[name]

    @property
    def url(self) -> str:
        """Address without credentials; those go into the options."""
        port = self.port or DEFAULT_PORTS[self.dialect]
        if self.dialect == "mysql":
            wait = f"connectTimeout={CONNECT_TIMEOUT_SECONDS * 1000}"
            return f"jdbc:mysql://{self.host}:{port}/{self.database}?{wait}&characterEncoding=utf8"
        return f"jdbc:postgresql://{self.host}:{port}/{self.database}?connectTimeout={CONNECT_TIMEOUT_SECONDS}"

    def options(self) -> dict[str, str]:
        return {
            "url": self.url,
            "driver": DRIVER_CLASSES[self.dialect],
            "user": self.user,
            "password": self.password,
            "fetchsize": str(FETCH_ROWS),
            "preferTimestampNTZ": "true",
        }


@dataclass(frozen=True)
class Split:
    """Cuts a table by a numeric column so that it is read by several tasks."""

    column: str
    lower: int
    upper: int
    parts: int

    def options(self) -> dict[str, str]:
        return {
            "partitionColumn": self.column,
            "lowerBound": str(self.lower),
            "upperBound": str(self.upper),
            "numPartitions": str(self.parts),
        }


@dataclass(frozen=True)
class RangeSplit:
    """Cuts a table at given values of a column, such as quantiles of an id; each part is one range of its index."""

    column: str
    cuts: tuple[int | str, ...]

    def predicates(self, dialect: str) -> list[str]:
        """One condition per part; each row with or without a value fulfils exactly one."""
        cuts = [f"'{cut.replace(chr(39), chr(39) * 2)}'" if isinstance(cut, str) else str(cut) for cut in self.cuts]
        if not cuts:
            return ["1 = 1"]
        inner = [f"{self.column} >= {low} AND {self.column} < {high}" for low, high in zip(cuts, cuts[1:])]
        return [f"{self.column} < {cuts[0]} OR {self.column} IS NULL", *inner, f"{self.column} >= {cuts[-1]}"]


@dataclass(frozen=True)
class HashSplit:
    """Cuts a table by a hash of any id column, computed by the database: one scan of the table per part."""

    column: str
    parts: int

    def predicates(self, dialect: str) -> list[str]:
        """One condition per part; each row with or without an id fulfils exactly one."""
        number = HASHES[dialect].format(column=self.column)
        conditions = [f"MOD({number}, {self.parts}) = {part}" for part in range(self.parts)]
        return [f"{conditions[0]} OR {self.column} IS NULL", *conditions[1:]]


def read_jdbc_table(
    spark: SparkSession,
    source: JdbcSource,
    table: str,
    columns: Sequence[str] | None = None,
    split: Split | RangeSplit | HashSplit | None = None,
) -> DataFrame:
    """A whole table, lazily; filters on it and the column list reach the database.

    Without ``split`` one task reads everything: give one for large tables
    (``id_split`` and ``hash_split`` find the parts). Parts are sized by rows; how many
    are read at a time is the number of executor cores, which is what bounds the connections.
    """
    if isinstance(split, RangeSplit | HashSplit):
        options = source.options()
        url = options.pop("url")
        df = spark.read.jdbc(url, table, predicates=split.predicates(source.dialect), properties=options)
    else:
        options = source.options() | {"dbtable": table} | (split.options() if split else {})
        df = spark.read.format("jdbc").options(**options).load()
    return df.select(*columns) if columns else df


def _ask(spark: SparkSession, source: JdbcSource, query: str) -> list:
    return spark.read.format("jdbc").options(**source.options(), dbtable=f"({query}) answer").load().collect()


def id_split(
    spark: SparkSession, source: JdbcSource, table: str, column: str = "id", rows_per_task: int = ROWS_PER_TASK
) -> Split | RangeSplit | None:
    """Parts of a table by a numeric id, as many as its rows need; None for an empty table.

    Ids that fill at least half of their span are cut into equal steps. Others, such as
    times, random or 64-bit numbers, are cut at quantiles, which the database finds in one
    pass over its index; one value per part comes back.
    """
    [(rows, low, high)] = _ask(spark, source, f"SELECT COUNT(*) AS n, MIN({column}) AS low, MAX({column}) AS high FROM {table}")
    if low is None:
        return None
    rows, low, high = int(rows), int(low), int(high)
    parts = -(-rows // rows_per_task)
    if 2 * rows >= high - low and -LONG <= low and high < LONG:
        return split_range(column, low, high, parts)
    return quantile_split(spark, source, table, column, parts)


LONG = 1 << 63


def split_range(column: str, low: int, high: int, parts: int) -> Split:
    return Split(column, low, min(high + 1, LONG - 1), max(1, min(parts, high - low + 1)))


def quantile_split(spark: SparkSession, source: JdbcSource, table: str, column: str, parts: int) -> RangeSplit:
    """Ranges of equal numbers of rows; rows with one value stay together."""
    if parts <= 1:
        return RangeSplit(column, ())
    placed = f"SELECT {column} AS v, NTILE({parts}) OVER (ORDER BY {column}) AS part FROM {table} WHERE {column} IS NOT NULL"
    lows = _ask(spark, source, f"SELECT part, MIN(v) AS low FROM ({placed}) placed GROUP BY part")
    cuts = sorted({low if isinstance(low, str) else int(low) for _, low in lows})
    return RangeSplit(column, tuple(cuts[1:]))


def hash_split(
    spark: SparkSession, source: JdbcSource, table: str, column: str = "id", rows_per_task: int = ROWS_PER_TASK
) -> HashSplit:
    """Parts of a table whose id is text, by its number of rows."""
    [(rows,)] = _ask(spark, source, f"SELECT COUNT(*) AS n FROM {table}")
    return HashSplit(column, int(rows) // rows_per_task + 1)
