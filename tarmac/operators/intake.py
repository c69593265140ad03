"""Raw rows → every row typed, and told what becomes of it: accepted, unexpected or dropped.

The clean step drops rows without a date, carrier or airport, and turns a cell that it cannot
read into null. Here nothing vanishes: each row keeps its fate and the codes of its failed
fields, and a dropped row its raw cells, so one pass over the source can write all of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac import schema as S
from tarmac.functions import month_key
from tarmac.operators.clean import RAW_TO_CLEAN, REQUIRED_FIELDS, TYPED_COLUMNS, add_derived, rename_columns, typed_columns

ACCEPTED, UNEXPECTED, DROPPED = "accepted", "unexpected", "dropped"
MISSING, MALFORMED, UNDECODABLE = "missing", "malformed", "undecodable"
REPLACEMENT = "\ufffd"  # what readers put for bytes that are not text

#: Fields whose text is parsed, and can fail.
PARSED_FIELDS = ["fl_date", "mkt_carrier_fl_num", *S.FLOAT_COLUMNS]
CELLS = "raw_cells"


def _typed_with_cells(raw: DataFrame) -> DataFrame:
    """The typed columns, and the raw cells under clean names in one struct."""
    cells = F.struct(*RAW_TO_CLEAN.values())
    return rename_columns(raw).withColumn(CELLS, cells).select(*typed_columns(), CELLS)


def reason_codes() -> Column:
    """``"malformed:fl_date,missing:origin"``: failed fields in column order, null if there is none.

    A required field without text is missing; text that its parser refuses is malformed,
    whether the field is required or not; other text with a replacement character is undecodable.
    """
    codes = []
    for field in TYPED_COLUMNS:
        text = F.col(CELLS)[field]
        if field in REQUIRED_FIELDS:
            codes.append(F.when(text.isNull(), f"{MISSING}:{field}"))
        if field in PARSED_FIELDS:
            codes.append(F.when(text.isNotNull() & F.col(field).isNull(), f"{MALFORMED}:{field}"))
        else:
            codes.append(F.when(text.contains(REPLACEMENT), f"{UNDECODABLE}:{field}"))
    return F.nullif(F.concat_ws(",", *codes), F.lit(""))


def tag(raw: DataFrame, expected_months: list[tuple[int, int]] | None = None, **derive) -> DataFrame:
    """Every raw row as a clean row, with ``fate``, ``reasons`` and, if dropped, ``raw_cells``.

    A row is dropped where the clean step would drop it; of the others those of a month outside
    ``expected_months`` are unexpected. The accepted rows are the rows of ``clean(raw)``, which
    ``derive`` options reach.
    """
    rows = add_derived(_typed_with_cells(raw).withColumn("reasons", reason_codes()), **derive)
    incomplete = F.lit(False)
    for field in REQUIRED_FIELDS:
        incomplete = incomplete | F.col(field).isNull()
    fate = F.when(incomplete, DROPPED)
    if expected_months is not None:
        keys = sorted({int(y) * 100 + int(m) for y, m in expected_months})
        fate = fate.when(~month_key("year", "month").isin(keys), UNEXPECTED)
    fate = fate.otherwise(ACCEPTED)
    columns = [f.name for f in S.CLEAN_SCHEMA.fields]
    return rows.select(
        *columns, "reasons", F.when(incomplete, F.col(CELLS)).alias(CELLS), fate.alias("fate")
    )


def reason_counts(tagged: DataFrame) -> DataFrame:
    """(fate, reason, n_rows) over rows with a failed field: why rows were dropped and cells emptied."""
    each = tagged.filter("reasons is not null").select("fate", F.explode(F.split("reasons", ",")).alias("reason"))
    return each.groupBy("fate", "reason").agg(F.count("*").alias("n_rows"))
