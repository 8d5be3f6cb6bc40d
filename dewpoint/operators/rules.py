"""The rule table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dewpoint.functions import no_bound_to_null
from dewpoint.schemas import BOUND_COLUMNS, DEFAULT_RULES, NO_BOUND, RULE_SCHEMA


def read_rules(spark: SparkSession, path: str, *, multi_line: bool = False) -> DataFrame:
    """Rules from a CSV file with a header; columns are found by name.

    Bounds become doubles whatever the file holds. A line with the wrong number of fields,
    text that is no number in a bound, or a rule without a code stops the read: as nulls
    they would turn into open bounds and the rule would fire on everything. An empty bound
    is an open one. ``multi_line`` allows line breaks inside quoted fields; such a file is
    read by one task. Codes keep their text unless all of them are whole numbers.
    """
    text = (
        spark.read.option("header", True)
        .option("mode", "FAILFAST")
        # Else a line is only checked for the columns a query uses.
        .option("columnPruning", False)
        .option("multiLine", multi_line)
        .csv(path)
    )
    code = F.col("code")
    whole = text.agg(F.bool_and(code.try_cast("int").isNotNull())).first()[0]
    kept_code = code.try_cast("int").cast("string") if whole else code
    return text.select(
        F.col("id").try_cast("int").alias("id"),
        *[_number(c).alias(c) for c in BOUND_COLUMNS],
        F.when(code.isNull(), F.raise_error(F.lit("rule without a code")).cast("string"))
        .otherwise(kept_code)
        .alias("code"),
        F.col("message"),
    )


def _number(name: str) -> Column:
    value = F.col(name).try_cast("double")
    problem = F.concat(F.lit(f"rule bound {name} is not a number: "), F.col(name))
    return F.when(
        F.col(name).isNotNull() & value.isNull(), F.raise_error(problem).cast("double")
    ).otherwise(value)


def clean_rules(rules: DataFrame, sentinel: float = NO_BOUND) -> DataFrame:
    """Null in place of the sentinel in the four bound columns."""
    return rules.select(
        *[
            no_bound_to_null(F.col(c), sentinel).alias(c) if c in BOUND_COLUMNS else F.col(c)
            for c in rules.columns
        ]
    )


def load_rules(spark: SparkSession, path: str) -> DataFrame:
    """Rules from a CSV file, ready for matching."""
    return clean_rules(read_rules(spark, path))


def default_rules(spark: SparkSession) -> DataFrame:
    """The four shipped rules, ready for matching, as literals in the plan."""
    fields = RULE_SCHEMA.fields
    rows = [
        F.struct(
            *[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(rule, fields, strict=True)]
        )
        for rule in DEFAULT_RULES
    ]
    return clean_rules(spark.range(1).select(F.inline(F.array(*rows))))
