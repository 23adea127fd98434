"""CSV scans with pandas' missing tokens and a declared or numeric-inferred schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..schema import NA_TOKENS, SALES_SCHEMA, q
from ..session import path_exists

#: Both directions: quotes doubled, blanks kept, line breaks allowed inside quotes.
CSV_OPTIONS = {
    "header": True, "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
#: An unquoted empty cell is missing, a quoted one is empty text.
READ_OPTIONS = {**CSV_OPTIONS, "nullValue": "\u0000"}
_EXTRA = "__extra"


def _known(col: Column, na_values: list[str]) -> Column:
    return F.when(~col.isin(na_values), col) if na_values else col


def _typed(col: Column, dtype: T.DataType, na_values: list[str], strict: bool) -> Column:
    """Cell text to a typed value; bad text raises when ``strict``, else gives null."""
    cell = _known(col, na_values)
    if isinstance(dtype, T.StringType):
        return cell
    if isinstance(dtype, T.IntegralType):
        whole = F.regexp_replace(F.trim(cell), r"\.0+$", "")  # 3.0 is how a float-typed writer spells 3
        return whole.cast(dtype) if strict else whole.try_cast(dtype)
    return F.trim(cell).cast(dtype) if strict else F.trim(cell).try_cast(dtype)


def _scan_text(spark: SparkSession, path: str, options: dict, multi_line: bool = True) -> DataFrame:
    """All columns as text, named by the header; a row with more cells than the header raises."""
    if not path_exists(spark, path):
        raise FileNotFoundError(path)
    reader = spark.read.options(**{**READ_OPTIONS, "multiLine": multi_line, **options})
    columns = reader.csv(path).columns
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*columns, _EXTRA]])
    rows = reader.option("enforceSchema", True).schema(schema).csv(path)
    message = F.concat(F.lit(f"a row of {path} has more cells than the header: "), F.col(_EXTRA))
    return rows.filter(F.when(F.col(_EXTRA).isNotNull(), F.raise_error(message).cast("boolean")).otherwise(True)).drop(_EXTRA)


def read_csv(
    spark: SparkSession,
    filename: str,
    base_path: str = "",
    schema: T.StructType | None = None,
    parse_dates: list[str] | None = None,
    na_values: list[str] | None = None,
    strict: bool = True,
    multi_line: bool = True,
    keep_default_na: bool = True,
    **options,
) -> DataFrame:
    """Scan a CSV file or folder under ``base_path``; missing files and extra cells raise.

    A quoted cell may hold line breaks, so a file is one task; for files without
    them ``multi_line=False`` lets Spark split large files.  Without
    ``keep_default_na`` only empty cells and ``na_values`` are missing.

    With ``schema`` the cells are cast to it by column name.  Without one a single aggregate
    decides per column between bigint, double, boolean and text (never a
    timestamp).  ``options`` go to Spark's reader.
    """
    path = f"{base_path.rstrip('/')}/{filename}" if base_path else filename
    tokens = (NA_TOKENS if keep_default_na else []) + list(na_values or [])
    text = _scan_text(spark, path, options, multi_line)
    if schema is None:
        schema = infer_types(text, tokens)
    absent = [f.name for f in schema.fields if f.name not in text.columns]
    if absent:
        raise ValueError(f"columns not in {path}: {absent}")
    df = text.select(*[
        _typed(F.col(q(f.name)), f.dataType, tokens, strict).alias(f.name) for f in schema.fields])
    for name in parse_dates or []:
        parse = F.to_timestamp if strict else F.try_to_timestamp
        df = df.withColumn(name, parse(F.col(q(name)).cast("string")))
    return df


def infer_types(text: DataFrame, tokens: list[str]) -> T.StructType:
    """Column types as a numeric reader would give them: a gap makes integers double."""
    tests = []
    for i, name in enumerate(text.columns):
        cell = _known(F.col(q(name)), tokens)
        text_of = F.trim(cell)
        number = text_of.try_cast("double").isNotNull() & ~text_of.rlike("[dDfF]$")
        tests += [
            F.count_if(cell.isNull()).alias(f"gaps{i}"),
            F.bool_and(text_of.rlike(r"^[+-]?\d{1,18}$")).alias(f"whole{i}"),
            F.bool_and(F.when(cell.isNotNull(), number)).alias(f"number{i}"),
            F.bool_and(text_of.isin("True", "False", "TRUE", "FALSE", "true", "false")).alias(f"truth{i}"),
        ]
    seen = text.agg(*tests).first()
    fields = []
    for i, name in enumerate(text.columns):
        if seen[f"whole{i}"] and not seen[f"gaps{i}"]:
            dtype = T.LongType()
        elif seen[f"number{i}"] or seen[f"number{i}"] is None:
            dtype = T.DoubleType()  # also an all-missing column
        elif seen[f"truth{i}"] and not seen[f"gaps{i}"]:
            dtype = T.BooleanType()
        else:
            dtype = T.StringType()
        fields.append(T.StructField(name, dtype))
    return T.StructType(fields)


def read_sales(
    spark: SparkSession,
    filename: str,
    base_path: str = "",
    on_bad_date: str = "null",
    na_values: list[str] | None = None,
    **options,
) -> DataFrame:
    """The canonical sales table.  Bad dates become null (count them with
    ``bad_dates``) or raise with ``on_bad_date="fail"``."""
    if on_bad_date not in ("null", "fail"):
        raise ValueError("on_bad_date must be 'null' or 'fail'")
    text_schema = T.StructType([
        T.StructField(f.name, T.StringType() if f.name == "Date" else f.dataType) for f in SALES_SCHEMA.fields])
    df = read_csv(spark, filename, base_path, schema=text_schema, na_values=na_values, **options)
    parse = F.to_timestamp if on_bad_date == "fail" else F.try_to_timestamp
    return df.withColumn("Date", parse("Date").cast("date"))


def bad_dates(spark: SparkSession, filename: str, base_path: str = "", column: str = "Date",
              na_values: list[str] | None = None, **options) -> DataFrame:
    """Number of cells that hold text but no date."""
    path = f"{base_path.rstrip('/')}/{filename}" if base_path else filename
    cell = _known(F.col(q(column)), NA_TOKENS + list(na_values or []))
    return _scan_text(spark, path, options).agg(
        F.count_if(cell.isNotNull() & F.try_to_timestamp(cell).isNull()).alias("bad_dates"))
