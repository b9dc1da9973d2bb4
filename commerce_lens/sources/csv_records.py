"""CSV records that span lines, read by many tasks.

A file is read as lines, in splits of any size. A line break is within a quoted field exactly where the number of quotes before it is
odd. So a first read counts the quotes of each split; summed over the splits before it, they tell how a split begins. A task
then puts the lines of its splits together as it reads them, so the text of records within a split is never shuffled or copied;
only the records that go on in another split are, in at most two parts a split.

A task holds one batch of lines and the record that is open, and a sum over splits has a row per split; nothing grows with a file.
A file whose quotes don't pair up is refused, as its last record would have no end.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from commerce_lens.session import cut_lineage, scratch_path

_SPLIT = ("file", "block")


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, block, no, value, odd): the lines of every split in order, and whether a line's quotes are odd in number."""
    lines = spark.read.option("lineSep", "\n").text(path)
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    return lines.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("no"),
        "value",
        (quotes % 2).alias("odd"),
    )


def splits(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, block, odds, before, whole): lines with odd quotes in each split, in the ones before, and in the file."""
    counted = _lines(spark, path).groupBy(*_SPLIT).agg(F.sum("odd").alias("odds"))
    of_file = Window.partitionBy("file")
    earlier = of_file.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return counted.select(*_SPLIT, "odds", F.coalesce(F.sum("odds").over(earlier), F.lit(0)).alias("before"), F.sum("odds").over(of_file).alias("whole"))


def _record_maker(ends: bool):
    """Puts the lines of splits together: their records as a whole, or, with `ends`, what reaches over the ends of a split.

    Lines come in order, those of a split side by side. Only the record that is open is held from one batch to the next.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, inside, header, opened, open_lines = None, 0, False, False, []
        out: list[tuple] = []

        def put(part: int | None) -> None:
            """What is held: a whole record (no part), or a part of one that begins or ends in another split."""
            nonlocal open_lines, header, opened
            if ends == (part is not None):
                out.append((split, header, part, opened, "\n".join(open_lines)))
            open_lines, header, opened = [], False, False

        def batch(records: pa.Array | None = None) -> pa.RecordBatch:
            """The parts at hand, and records that are the first of no file."""
            nonlocal out
            n = len(records) if records is not None else 0
            columns = [pa.array([r[i] for r in out], f.type) for i, f in enumerate(_MADE)]
            more = [pa.nulls(n, f.type) for f in _MADE][:-1] + [records if n else pa.nulls(0, pa.string())]
            out = []
            return pa.RecordBatch.from_arrays([pa.concat_arrays([a, b]) for a, b in zip(columns, more)], schema=_MADE)

        for b in batches:
            numbers, odd = b["split"].to_numpy(), b["odd"].to_numpy()
            bounds = [0, *(np.flatnonzero(numbers[1:] != numbers[:-1]) + 1), len(numbers)]
            for lo, hi in zip(bounds, bounds[1:]):
                if lo == hi:
                    continue
                if numbers[lo] != split:
                    if inside:
                        put(1 if opened else 0)
                    split, inside = int(numbers[lo]), int(b["before"][lo].as_py()) % 2
                    # Before the first line of a file its header is looked for.
                    first, opened = bool(b["first"][lo].as_py()), False
                state = inside + np.cumsum(odd[lo:hi])
                starts = lo + np.flatnonzero((state - odd[lo:hi]) % 2 == 0)
                upto = int(starts[0]) if len(starts) else hi
                if inside:
                    open_lines += b["value"].slice(lo, upto - lo).to_pylist()
                    if len(starts) or state[-1] % 2 == 0:
                        put(None if opened else 0)
                inside = int(state[-1] % 2)
                if first and len(starts):
                    # The header by itself; the rest goes on without.
                    until = int(starts[1]) if len(starts) > 1 else hi
                    open_lines, header, opened, first = b["value"].slice(upto, until - upto).to_pylist(), True, True, False
                    starts = starts[1:]
                    if len(starts) or not inside:
                        put(None)
                if len(starts):
                    stops = [*starts[1:], hi]
                    if inside:
                        open_lines, opened = b["value"].slice(int(starts[-1]), hi - int(starts[-1])).to_pylist(), True
                        starts, stops = starts[:-1], stops[:-1]
                    if len(starts) and not ends:
                        offsets = pa.array(np.array([starts[0], *stops], dtype=np.int32))
                        lists = pa.ListArray.from_arrays(offsets, b["value"])
                        yield batch(pc.binary_join(lists, "\n"))
            if out:
                yield batch()
        if inside:
            put(1 if opened else 0)
        if out:
            yield batch()

    return run


_MADE = pa.schema([("split", pa.int64()), ("header", pa.bool_()), ("part", pa.int32()), ("opens", pa.bool_()), ("value", pa.string())])
_MADE_DDL = "split long, header boolean, part int, opens boolean, value string"


def records(spark: SparkSession, path: str | list[str], known: DataFrame) -> DataFrame:
    """(file, header, value): every record of the files as text, blank ones left out; `known` are the stored splits() of path.

    The file is known of headers and of records that go on in another split. Text is read twice, once for whole records and once
    for those; only those are shuffled.
    """
    unpaired = F.raise_error(F.concat(F.lit("unpaired quotes in "), F.col("file")))
    known = known.withColumn("before", F.when(F.col("whole") % 2 == 0, F.col("before")).otherwise(unpaired.cast("long")))
    # One row per split.
    known = known.withColumn("split", F.row_number().over(Window.orderBy(*_SPLIT)).cast("long"))
    numbered = F.broadcast(known.select(*_SPLIT, "split", "before", "odds"))
    lines = _lines(spark, path).join(numbered, list(_SPLIT))
    inputs = [F.col("split"), F.col("before"), (F.col("block") == 0).alias("first"), F.col("odd").cast("long").alias("odd"), F.col("value")]
    names = F.broadcast(known.select("split", *_SPLIT))
    whole = lines.select(*inputs).mapInArrow(_record_maker(ends=False), _MADE_DDL)
    whole = whole.join(names, "split", "left").select("file", F.coalesce("header", F.lit(False)).alias("header"), "value")
    crossed = lines.where((F.col("before") % 2 == 1) | ((F.col("before") + F.col("odds")) % 2 == 1))
    parts = crossed.select(*inputs).mapInArrow(_record_maker(ends=True), _MADE_DDL).join(names, "split")
    # At most two parts a split: each belongs to the record that the last opening part before it began.
    in_order = Window.partitionBy("file").orderBy("block", "part")
    of_record = parts.withColumn("no", F.sum(F.col("opens").cast("long")).over(in_order))
    joined = of_record.groupBy("file", "no").agg(
        F.bool_or("header").alias("header"), F.array_sort(F.collect_list(F.struct("block", "part", "value"))).alias("parts")
    )
    long = joined.select("file", "header", F.array_join("parts.value", "\n").alias("value"))
    found = whole.unionByName(long)
    # The end of a line is no part of the record, nor is a byte order mark.
    value = F.regexp_replace(F.regexp_replace("value", "\r$", ""), "^\ufeff", "")
    return found.select("file", "header", _those(F.trim(value) != "", value))


def _those(condition: Column, value: Column) -> Column:
    """The values that meet a condition. Being generated, they keep whatever a caller asks of a record from lines that are none."""
    return F.explode(F.when(condition, F.array(value))).alias("value")


def _names(header: str, options: dict[str, str], spark: SparkSession) -> list[str]:
    """The column names of a header record, as Spark's own reader makes them of it."""
    path = scratch_path(spark, "header")
    spark.createDataFrame([(header.replace("\n", " "),)], "value string").write.text(path)
    return spark.read.options(**options).csv(path).columns


def read_records(spark: SparkSession, path: str | list[str], schema: StructType | str | None, options: dict[str, str]) -> DataFrame | None:
    """The table in files with quoted line breaks, each of which has a header; None if no record spans lines.

    Without a schema the types are those that Spark's reader infers from the records, at the price of a copy of them. A record
    that doesn't fit the schema fails the job.
    """
    known = cut_lineage(splits(spark, path), "splits")
    if not known.where("odds > 0").limit(1).count():
        return None
    found = records(spark, path, known)
    if schema is None:
        found = cut_lineage(found, "records")
        first = found.where("header").orderBy("file").limit(1).collect()
        names = _names(first[0]["value"], options, spark)
        flat = found.where("NOT header").select(F.translate("value", "\n\r", "  ")).rdd.map(lambda r: r[0])
        texts = StructType([StructField(n, StringType()) for n in names])
        inferred = spark.read.options(**{**options, "header": "false"}).option("inferSchema", "true").csv(flat).schema
        # A header alone tells names, not types.
        schema = StructType([StructField(n, f.dataType) for n, f in zip(names, inferred)]) if len(inferred) else texts
    elif isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    fields = {k: v for k, v in options.items() if k != "header"} | {"mode": "FAILFAST"}
    body = found.select(_those(~F.col("header"), F.col("value")))
    return body.select(F.from_csv("value", _ddl(schema), fields).alias("r")).select("r.*")


def _ddl(schema: StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
