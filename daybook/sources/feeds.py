"""Source adapters: read a feed with its declared columns and normalise its keys.

Feeds may carry CENTER as text or float and PERIOD as 'yyyymmdd' text.  Window
filters, and center filters on numeric centers, are applied to the *raw* columns
first (so they reach the Parquet scan), then keys become ``CENTER int`` /
``PERIOD int``.  A text center is read as a number ('61', '061' and '61.0' are
center 61) and filtered after that; what is no whole number becomes NULL.
``reject_counts`` counts what normalisation cannot use.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType


# Kinds of feed columns: types a declared column may have as stored.
KEY_TYPES = ("int", "bigint", "smallint", "float", "double", "decimal", "string")
NUMBER_TYPES = ("int", "bigint", "smallint", "float", "double", "decimal")


def _check(df: DataFrame, declared: dict[str, tuple[str, ...]], what: str) -> DataFrame:
    have = {f.name.upper(): f.dataType.simpleString().split("(")[0] for f in df.schema.fields}
    missing = [c for c in declared if c.upper() not in have]
    wrong = [f"{c} is {have[c.upper()]}" for c, kinds in declared.items() if c.upper() in have and have[c.upper()] not in kinds]
    if missing or wrong:
        raise ValueError(f"{what}: missing columns {missing}; unusable types {wrong}")
    return df.select(*[F.col(f"`{c}`").alias(c) for c in declared])


def read_daily(spark: SparkSession, path: str, columns: list[str], text: bool = False) -> DataFrame:
    """A wide daily feed (CENTER, PERIOD, measures); ``text``: measures may be text."""
    kinds = KEY_TYPES if text else NUMBER_TYPES
    return _check(spark.read.parquet(path), {"CENTER": KEY_TYPES, "PERIOD": KEY_TYPES, **{c: kinds for c in columns}}, path)


def read_account_feed(spark: SparkSession, path: str, value: str = "DATA_VALUE") -> DataFrame:
    """An account feed: CENTER, PERIOD, ACCOUNT, value, EXTRACT_DATE_ID."""
    return _check(spark.read.parquet(path), {"CENTER": KEY_TYPES, "PERIOD": KEY_TYPES, "ACCOUNT": ("string",), value: NUMBER_TYPES,
                                             "EXTRACT_DATE_ID": ("int", "bigint")}, path)


def read_hierarchy(spark: SparkSession, path: str) -> DataFrame:
    return _check(spark.read.parquet(path), {"CENTER": KEY_TYPES, "REGNAME": ("string",)}, path)


def read_calendar(spark: SparkSession, path: str) -> DataFrame:
    return _check(spark.read.parquet(path), {"CALENDAR_DATE_ID": ("int", "bigint"), "CALENDAR_DATE": ("date",)}, path)


def _is_text(df: DataFrame, col: str) -> bool:
    return isinstance(df.schema[col].dataType, StringType)


def whole_number_sql(col: str) -> str:
    """An int where the value (text included) is a whole number, else NULL."""
    number = f"try_cast({col} AS DOUBLE)"
    return f"CASE WHEN {number} = floor({number}) THEN try_cast({number} AS INT) END"


def day_sql(col: str = "PERIOD") -> str:
    """The calendar day of a yyyymmdd key (text or number), NULL for all else."""
    text = f"CAST({col} AS STRING)"
    return f"CASE WHEN {text} RLIKE '^[0-9]{{8}}$' THEN try_to_date({text}, 'yyyyMMdd') END"


def is_day_sql(col: str = "PERIOD") -> str:
    """Whether an int key is a calendar day; the first 28 days of a month need no date."""
    return (f"({col} BETWEEN 10000101 AND 99991231 AND (({col} % 100 BETWEEN 1 AND 28 AND {col} div 100 % 100 BETWEEN 1 AND 12) "
            f"OR {day_sql(col)} IS NOT NULL))")


def normalise_keys(df: DataFrame) -> DataFrame:
    """CENTER -> int (roll-up names become NULL), PERIOD -> int."""
    others = [f"`{c}`" for c in df.columns if c.upper() not in ("CENTER", "PERIOD")]
    center = "CENTER" if isinstance(df.schema["CENTER"].dataType, IntegerType) else f"{whole_number_sql('CENTER')} AS CENTER"
    return df.selectExpr(center, "try_cast(PERIOD AS int) AS PERIOD", *others)


def window_feed(df: DataFrame, lo: int, hi: int, center_rule=None, columns: list[str] | None = None, watch=None) -> DataFrame:
    """Filter a raw feed to [lo, hi] (+ optional center rule), then normalise keys.

    ``watch`` (a function of the raw rows of the window) may hang an observation on them: it sees the rows before the
    center rule.  With a center rule, rows whose center is no whole number are left out, and those whose period is no calendar day always."""
    quote = "'" if _is_text(df, "PERIOD") else ""
    # literals typed like the raw key, so the predicate pushes down
    out = df.where(f"PERIOD BETWEEN {quote}{int(lo)}{quote} AND {quote}{int(hi)}{quote}")
    out = out if watch is None else watch(out)
    raw_rule = center_rule is not None and not _is_text(df, "CENTER")
    if raw_rule:
        out = out.where(center_rule.sql("CENTER") if hasattr(center_rule, "sql") else center_rule(F.col("CENTER")))
    if columns is not None:
        out = out.selectExpr("CENTER", "PERIOD", *[f"`{c}`" for c in columns])
    whole = isinstance(df.schema["CENTER"].dataType, IntegerType)
    out = normalise_keys(out).where(is_day_sql())
    if raw_rule:
        return out if whole else out.where("CENTER IS NOT NULL")
    return out if center_rule is None else out.where(center_rule(F.col("CENTER")))


def reject_counts(df: DataFrame, numbers: list[str] = ()) -> DataFrame:
    """Rows (FIELD, N_ROWS): values present that normalisation turns into NULL, for CENTER, PERIOD
    and the text measures ``numbers``.  Fields without a reject are left out."""
    bad = {"CENTER": whole_number_sql("CENTER"), "PERIOD": "try_cast(PERIOD AS int)",
           **{c: f"try_cast(`{c}` AS DOUBLE)" for c in numbers}}
    one = df.selectExpr(*[f"count_if(`{c}` IS NOT NULL AND ({e}) IS NULL) AS `{c}`" for c, e in bad.items()])
    pairs = ", ".join(f"'{c}', `{c}`" for c in bad)
    return one.selectExpr(f"stack({len(bad)}, {pairs}) AS (FIELD, N_ROWS)").where("N_ROWS > 0")


def write_clustered(df: DataFrame, path: str, mode: str = "errorifexists", row_group_bytes: int | None = None) -> None:
    """A feed as Parquet in the order of PERIOD and CENTER, so that the pushed bounds of a run's window skip files and row groups.

    Ranges are cut by a hash of the row behind the two keys: a day or a center with a large share of the rows is split
    over tasks, and a retried task makes the same rows."""
    place = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    writer = df.repartitionByRange("PERIOD", "CENTER", place).sortWithinPartitions("PERIOD", "CENTER").write.mode(mode)
    if row_group_bytes is not None:
        writer = writer.option("parquet.block.size", row_group_bytes)
    writer.parquet(path)


def read_partitions(spark: SparkSession, table: str, ranges: list[tuple[int, int]], col: str = "PERIOD",
                    schema=None) -> DataFrame:
    """Read only the ``col=<key>`` partitions of a Parquet table that fall in
    ``ranges`` (inclusive day keys).

    A plain-path table is otherwise discovered by listing every partition
    (years of days) before pruning; here one non-recursive listing of the
    table root picks the directories and only those are scanned.  With a
    catalog-managed table, ``spark.table(...).where(...)`` prunes the same way.
    On a first run (no partitions yet) pass ``schema`` to get an empty frame.
    """
    from daybook.operators.reload import partition_dirs
    parts = partition_dirs(spark, table, col)
    if not parts:
        if schema is not None:
            return spark.createDataFrame([], schema)
        raise ValueError(f"{table}: no {col}= partitions")
    keep = [p for k, p in sorted(parts.items()) if any(lo <= k <= hi for lo, hi in ranges)]
    reader = spark.read.option("basePath", table)
    if schema is not None:  # columns and types as declared, whatever the first file says
        reader = reader.schema(schema)
    if keep:
        return reader.parquet(*keep)
    return reader.parquet(next(iter(parts.values()))).where(F.lit(False))
