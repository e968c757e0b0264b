"""Raw transaction files: reading, renaming and type coercion."""

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from duebook import constants as K

DATE_FORMATS = ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd", "M/d/yyyy H:mm")
NUMBER = "decimal(18,4)"


CORRUPT = "corrupt_record"
FAULT = "line_fault"


def _line_fault(line: Column, fields: int) -> Column:
    """What is wrong with a raw line that was not read as `fields` fields."""
    bare = F.translate(line, "\u0001", "")
    # Quoted stretches become one mark; what remains of a well quoted line has no quote, and
    # marks stand between delimiters only (a doubled quote is two marks side by side).
    marked = F.regexp_replace(bare, '"[^"]*"', "\u0001")
    stray = marked.contains('"') | marked.rlike("[^,\u0001]\u0001") | marked.rlike("\u0001[^,\u0001]")
    n = F.length(marked) - F.length(F.translate(marked, ",", "")) + 1
    count = F.concat(n.cast("string"), F.lit(f" of {fields} fields"))
    return F.when(line.isNull(), None).when(stray, "bad quotes").otherwise(count)


def read_raw_transactions(spark: SparkSession, parts, fmt="csv", multiline=False, faults=False) -> DataFrame:
    """All parts as one frame of text columns, each row tagged with the part it came from.

    `parts` maps a part name to its path, or lists paths, which are then tagged by file name.
    Columns are matched by name; a part that lacks a column gets NULL in it.  Every path is
    read by its own header; a folder whose files have different headers is an error.  Quotes
    inside quoted text are doubled; `multiline` allows line breaks in it, at the price that a
    file is read by one task.

    With `faults`, CSV lines that have fewer or more fields than their header, or whose quotes
    do not close before a delimiter, come with the line as it stands in `corrupt_record` and
    what is wrong with it in `line_fault`; both are NULL in all other rows.  Blank lines are no
    rows.  A stray quote in an unquoted field, or behind the quoted text of a last field, is text.
    """
    named = list(parts.items()) if isinstance(parts, dict) else [(None, p) for p in parts]
    options = {"header": True, "enforceSchema": False, "escape": '"', "multiLine": multiline}

    def read(name, path):
        reader, more = spark.read, []
        if fmt == "csv":
            reader = reader.options(**options)
        if fmt == "csv" and faults:
            columns = reader.csv(path).columns  # the header line only
            shape = StructType([StructField(c, StringType()) for c in [*columns, CORRUPT]])
            df = reader.schema(shape).options(
                mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT, unescapedQuoteHandling="STOP_AT_CLOSING_QUOTE"
            ).csv(path)
            more = [F.col(CORRUPT), _line_fault(F.col(CORRUPT), len(columns)).alias(FAULT)]
        else:
            df = reader.format(fmt).load(path)
        origin = F.col("_metadata.file_name") if name is None else F.lit(name)
        return df.select(
            *[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns if not more or c != CORRUPT],
            origin.alias("source_part"), *more,
        )

    return reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True),
        [read(name, path) for name, path in named],
    )


def fault_rules(df: DataFrame) -> dict[str, Column]:
    """Rules, for `split_rejects`, that malformed lines break."""
    if FAULT not in df.columns:
        return {}
    fault = F.col(FAULT)
    return {
        "line with bad quotes": fault == "bad quotes",
        "line with too few or too many fields": fault.isNotNull() & (fault != "bad quotes"),
    }


def conform_columns(df: DataFrame) -> DataFrame:
    """Staging column names instead of the file's header; lists the headers that are missing."""
    missing = [target for header, target in K.RAW_HEADER.items()
               if header not in df.columns and target not in df.columns]
    if missing:
        raise ValueError("Missing source columns: " + ", ".join(missing))
    return df.withColumnsRenamed(K.RAW_HEADER)


def _number(name: str) -> Column:
    return F.col(name).try_cast(NUMBER)


def _instant(name: str, formats) -> Column:
    return F.coalesce(*[F.try_to_timestamp(F.col(name), F.lit(f)) for f in formats])


def coerce_types(df: DataFrame, date_formats=DATE_FORMATS) -> DataFrame:
    """Typed staging columns; unreadable dates and numbers become NULL."""
    return df.withColumns(
        {
            "quantity": _number("quantity"),
            "unit_price": _number("unit_price"),
            "invoice_date": _instant("invoice_date", date_formats),
            "customer_id": F.col("customer_id").try_cast("decimal(38,4)").try_cast("bigint"),
        }
    )
