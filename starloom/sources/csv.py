"""CSV scans."""

from __future__ import annotations

import uuid
from collections.abc import Collection

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.functions import to_number
from starloom.names import quoted
from starloom.sources.records import CsvLines, find_splits, read_records

# Texts that count as missing in a typed scan.
MISSING_TEXTS = [
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
]

_CORRUPT = "_corrupt_record"
_FIELDS = "__fields"
# One field with the delimiter before it: quoted, with doubled quotes inside, or plain.
_FIELD = r'(?s)(?:^|,)(?:"[^"]*+(?:""[^"]*+)*+"[^,]*+|[^,]*+)'


def _options(multi_line: bool) -> dict:
    # A quote inside a quoted field is doubled; a backslash is an ordinary character. Each file's
    # header is compared with the names that are expected. What stands for a field that is empty
    # and not quoted is new each time, so that no data can hold it.
    return {
        "nullValue": uuid.uuid4().hex,
        "emptyValue": "",
        "header": True,
        "quote": '"',
        "escape": '"',
        "multiLine": multi_line,
        "enforceSchema": False,
    }


def _fields(record: Column) -> Column:
    """The fields of a record's text; none of its characters has a meaning of its own."""
    raw = F.regexp_extract_all(record, F.lit(_FIELD), 0)
    plain = F.transform(raw, lambda x, i: F.when(i == 0, x).otherwise(F.substr(x, F.lit(2))))

    def unquoted(field: Column) -> Column:
        inner = F.regexp_extract(field, r'(?s)^"([^"]*+(?:""[^"]*+)*+)"', 1)
        text = F.replace(inner, F.lit('""'), F.lit('"'))
        return F.when(F.startswith(field, F.lit('"')), text).otherwise(field)

    return F.transform(plain, unquoted)


def _scan(spark: SparkSession, path: str) -> tuple[list[str], DataFrame]:
    """The header's names, and all rows as text with the fields of those of another length.

    A pass over the lines that hold quotes tells whether any field has line breaks. Without,
    every line is a record; else records are cut out first. Either way large files are read in
    many tasks, and Spark parses the fields.
    """
    grammar = CsvLines()
    splits = find_splits(spark, path, grammar)
    options = _options(splits.broken_lines)
    if splits.broken_lines:
        names, records = _headed(read_records(spark, path, grammar, splits))
        rows = _parsed(records, names, options)
    else:
        names = spark.read.options(**options).csv(path).columns
        fields = [T.StructField(name, T.StringType()) for name in names]
        corrupt = T.StructField(_CORRUPT, T.StringType())
        rows = spark.read.options(**options).schema(T.StructType([*fields, corrupt])).csv(path)
    # Rows with too few or too many fields come with their own text.
    ragged = F.when(F.col(_CORRUPT).isNotNull(), _fields(F.col(_CORRUPT)))
    return names, rows.select(*[quoted(name) for name in names], ragged.alias(_FIELDS))


def _headed(records: DataFrame) -> tuple[list[str], DataFrame]:
    """The names of the first record, and ``text`` of all records but the files' first ones.

    Those must be alike in all files. As in Spark's own scan, a name that is missing or repeated
    is made from its place.
    """
    line = F.when(F.endswith("text", F.lit("\r")), F.expr("left(text, length(text) - 1)"))
    records = records.withColumn("text", F.coalesce(line, "text"))
    header = _fields(F.regexp_replace("text", "^\ufeff", ""))
    found = records.where("first").select(header).first()[0]
    seen = [name.lower() for name in found]
    names = [
        f"_c{place}" if not name else f"{name}{place}" if seen.count(name.lower()) > 1 else name
        for place, name in enumerate(found)
    ]
    told = F.concat(F.lit("another header than the first file's: "), "text")
    other = F.col("first") & (header != F.array(*[F.lit(name) for name in found]))
    failed = F.when(other, F.raise_error(told).cast("boolean"))
    return names, records.where(F.coalesce(failed, ~F.col("first"))).select("text")


def _parsed(records: DataFrame, names: list[str], options: dict) -> DataFrame:
    schema = ", ".join([*(f"f{i} string" for i in range(len(names))), f"{_CORRUPT} string"])
    given = {
        **{k: str(options[k]).lower() for k in ("multiLine",)},
        **{k: options[k] for k in ("nullValue", "emptyValue", "quote", "escape")},
        "lineSep": "\n",
        "columnNameOfCorruptRecord": _CORRUPT,
    }
    row = records.select(F.from_csv("text", schema, given).alias("row"))
    return row.select(
        *[F.col(f"row.f{i}").alias(name) for i, name in enumerate(names)],
        F.col(f"row.{_CORRUPT}").alias(_CORRUPT),
    )


def _surplus(names: list[str]) -> Column:
    return F.size(_FIELDS) > len(names)


def _whole(rows: DataFrame, names: list[str]) -> DataFrame:
    """``rows``, but an error if one has more fields than the header."""
    # Spark wants a field to be read beside the record's own text.
    told = F.concat_ws(
        " ", F.lit(f"more than {len(names)} fields:"), F.to_json(_FIELDS), F.left(quoted(names[0]), F.lit(0))
    )
    failed = F.when(_surplus(names), F.raise_error(told).cast("boolean"))
    return rows.where(F.coalesce(failed, F.lit(True)))


def read_csv_text(
    spark: SparkSession,
    path: str,
    rest: str | None = None,
    empty_is_null: bool = False,
) -> DataFrame:
    """Every field as text, under the names of the header row.

    An empty field is an empty string, or null with ``empty_is_null`` unless it is quoted; a
    field missing from a short row is null. Surplus fields are an error unless ``rest`` names a
    column for them, an ``array<string>`` that is null in other rows. Blank lines are skipped. A
    file with another header than the first one's is an error, and so is one that ends inside a
    quoted field. Lines end with a line feed, with or without a carriage return; fields may hold
    line breaks, and large files are read in many tasks all the same.
    """
    names, rows = _scan(spark, path)
    rows = rows if rest else _whole(rows, names)

    def field(place: int, name: str) -> Column:
        text = F.col(quoted(name))
        if not empty_is_null:
            missing = F.coalesce(F.size(_FIELDS) <= place, F.lit(False))
            text = F.when(~missing, F.coalesce(text, F.lit("")))
        return text.alias(name)

    columns = [field(place, name) for place, name in enumerate(names)]
    if rest:
        if rest in names:
            raise ValueError(f"column exists already: {rest}")
        behind = F.slice(_FIELDS, len(names) + 1, F.greatest(F.size(_FIELDS), F.lit(1)))
        columns.append(F.when(_surplus(names), behind).alias(rest))
    return rows.select(*columns)


def _typed(text: Column, data_type: T.DataType, missing: Collection[str]) -> Column:
    if isinstance(data_type, T.NumericType):
        return to_number(text, data_type.simpleString(), missing)
    present = F.when(~text.isin(*missing), text) if missing else text
    if isinstance(data_type, T.StringType):
        return present
    if isinstance(data_type, (T.StructType, T.ArrayType, T.MapType)):
        return F.from_json(present, data_type, {"mode": "FAILFAST"})
    return present.cast(data_type)


def _inferred(rows: DataFrame, missing: Collection[str]) -> T.StructType:
    """Types by all present texts: long, double, boolean, or text.

    A column of whole numbers in which some are missing is a double, one that holds nothing too.
    """

    def tests(name: str) -> list[Column]:
        text = F.col(quoted(name))
        present = text.isNotNull() & ~text.isin(*missing) if missing else text.isNotNull()
        tries = {
            "long": text.rlike(r"^\s*[+-]?\d+\s*$") & text.try_cast("bigint").isNotNull(),
            "double": text.rlike(r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$")
            | F.lower(F.trim(text)).rlike("^[+-]?inf(inity)?$"),
            "boolean": text.isin("True", "TRUE", "true", "False", "FALSE", "false"),
        }
        failed = [F.count_if(present & ~test) for test in tries.values()]
        return [F.count_if(~present), *failed]

    tested = [F.array(*tests(name)).alias(name) for name in rows.columns]
    counts = rows.agg(F.struct(*tested)).first()
    schema = T.StructType()
    for name, (absent, no_long, no_double, no_boolean) in zip(rows.columns, counts[0]):
        if not no_long and not absent:
            kind = T.LongType()
        elif not no_double:
            kind = T.DoubleType()
        elif not no_boolean and not absent:
            kind = T.BooleanType()
        else:
            kind = T.StringType()
        schema.add(name, kind)
    return schema


def read_csv_typed(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    missing: Collection[str] = MISSING_TEXTS,
) -> DataFrame:
    """Fields as the types of ``schema``, with the texts of ``missing`` as null.

    Columns are matched to the header by name, and come in the order of ``schema``; a name that
    only one of them has is an error, and so are a file with another header or one that ends
    inside a quoted field, and a row with surplus fields. Numeric text that does not parse fails
    the job. Nested columns are read from JSON text. Large files are read in many tasks.

    Without a schema the types are found in an extra pass over the texts: whole numbers,
    numbers, booleans, or text, which stays as it is. Pass ``missing=()`` to keep ``NA`` and the
    like as texts; an empty field that is not quoted is null all the same.
    """
    names, rows = _scan(spark, path)
    texts = _whole(rows, names).select(*[quoted(name) for name in names])
    if schema is None:
        target = _inferred(texts, missing)
    else:
        target = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        if sorted(target.names) != sorted(names):
            raise ValueError(f"the header has {names}, the schema {target.names}")
    return texts.select(
        *[_typed(F.col(quoted(f.name)), f.dataType, missing).alias(f.name) for f in target.fields]
    )
