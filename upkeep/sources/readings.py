"""Reading sensor tables."""

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from upkeep import defaults as D
from upkeep.operators.columns import add_power_w, add_temp_diff, encode_category, rename_columns, require_columns


def _missing_as_file_error(read, path):
    try:
        return read()
    except AnalysisException as e:
        if (e.getCondition() or "").startswith("PATH_NOT_FOUND"):
            raise FileNotFoundError(path) from e
        raise


def read_readings(spark: SparkSession, path: str, types: dict = None) -> DataFrame:
    """CSV with a header, or Parquet when the path says so; blanks around header names are stripped.

    Types are given by name, never inferred: only the header is read before the scan. A cell that
    does not parse fails the job; the words for a missing value give null. Columns without a given
    type stay strings. An integer may be written with a fraction of zero.
    """
    if path.rstrip("/").endswith(".parquet"):
        df = _missing_as_file_error(lambda: spark.read.parquet(path), path)
        return df.toDF(*[c.strip() for c in df.columns])
    df = _missing_as_file_error(lambda: spark.read.option("header", True).option("enforceSchema", False).csv(path), path)
    df = df.toDF(*[c.strip() for c in df.columns])
    types = D.RAW_TYPES if types is None else types

    def typed(c):
        cell = F.trim(F.col(f"`{c}`"))
        known = F.when(~cell.isin(D.MISSING), cell)
        if types[c].typeName() not in ("integer", "long"):
            return known.cast(types[c]).alias(c)
        number, exact = known.cast("double"), known.try_cast("decimal(38,18)")  # 108.0 is the integer 108; a fraction is an error
        whole = F.when((number == F.floor(number)) & (exact == F.floor(exact)), exact.cast(types[c]))
        plain = known.try_cast(types[c])  # all digits count, also beyond those of a double
        return F.when(plain.isNotNull(), plain).when(number.isNull() | whole.isNotNull(), whole).otherwise(
            F.raise_error(F.concat(F.lit(f"{c}: not an integer: "), cell)).cast(types[c])).alias(c)

    def said(c):
        return F.when(~F.trim(F.col(f"`{c}`")).isin(D.MISSING), F.col(f"`{c}`")).alias(c)

    return df.select(*[typed(c) if c in types and types[c].typeName() != "string" else said(c) for c in df.columns])


def load_readings(spark: SparkSession, path: str) -> DataFrame:
    """Readings with canonical names, category code, temperature difference and power."""
    df = rename_columns(read_readings(spark, path))
    require_columns(df, [*D.OPERATING, D.CATEGORY, D.TARGET])
    return add_power_w(add_temp_diff(encode_category(df)))


# A blank inside a JSON string, as itself or escaped, and a run of what is not one. Possessive, so long strings need no stack.
_CODES = "00(?:09|0[aA]|0[bB]|0[cC]|0[dD]|1[c-fC-F]|20|85|[aA]0)|1680|20(?:0[0-9aA]|28|29|2[fF]|5[fF])|3000"
_BLANK = rf"(?:[\s\x1c-\x1f\x85\x{{a0}}\x{{1680}}\x{{2000}}-\x{{200a}}\x{{2028}}\x{{2029}}\x{{202f}}\x{{205f}}\x{{3000}}]|\\[tnrf]|\\u(?:{_CODES}))"
_SOLID = rf"(?:(?!{_BLANK})(?:[^\"\\]|\\.))"
_STRING = rf'"{_BLANK}*+((?:{_BLANK}*+{_SOLID}++)*+){_BLANK}*+"'


def trim_json(df: DataFrame, column: str, out: str = None) -> DataFrame:
    """Strip blanks around every key and string value of a JSON document, at any depth; the rest stays as written.

    One expression in the JVM: outside strings JSON has no quotes, so each match is a string. Text that is no JSON fails the job.
    Keys that become equal all stay.
    """
    doc = F.col(column)
    sound = F.get_json_object(doc, "$").isNotNull() | (F.trim(doc) == "null")
    trimmed = F.regexp_replace(doc, _STRING, '"$1"')
    return df.withColumn(out or column, F.when(doc.isNull() | sound, trimmed).otherwise(F.raise_error(F.concat(F.lit("not JSON: "), doc)).cast("string")))
