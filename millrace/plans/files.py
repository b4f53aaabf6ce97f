"""Queries: CSV round trips, file listings and class folders, on files written from the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import map_value
from millrace.plans.registry import query
from millrace.session import dealt, partitions_for, scratch_path
from millrace.sources import class_names, list_files, preview_lines, read_csv, read_image_folder, table


def _written_orders(spark, sf, **options) -> str:
    path = scratch_path(spark, "orders_csv")
    rows = table(spark, sf, "orders").drop("o_orderdate")
    rows.write.options(**options).csv(path)
    return path


@query("csv_schema", "SELECT o_orderkey, o_custkey, ' ' || o_orderstatus AS o_orderstatus, o_totalprice, o_orderpriority FROM orders")
def csv_schema(spark, sf):
    """Declared schema; leading blanks are part of the value."""
    path = scratch_path(spark, "orders_csv")
    rows = table(spark, sf, "orders").drop("o_orderdate")
    blank = rows.withColumn("o_orderstatus", F.concat(F.lit(" "), F.col("o_orderstatus")))
    blank.write.options(ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)
    return read_csv(spark, path, schema=rows.schema)


@query("csv_trim", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders")
def csv_trim(spark, sf):
    path = scratch_path(spark, "orders_csv")
    rows = table(spark, sf, "orders").drop("o_orderdate")
    blank = rows.withColumn("o_orderstatus", F.concat(F.lit(" "), F.col("o_orderstatus")))
    blank.write.options(ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)
    return read_csv(spark, path, schema=rows.schema, trim=True)


@query(
    "csv_infer",
    """SELECT o_orderkey::INT AS _c0, o_custkey::INT AS _c1, nullif(o_orderstatus, 'P') AS _c2, o_totalprice AS _c3,
       o_orderpriority AS _c4 FROM orders""",
)
def csv_infer(spark, sf):
    """No header, types from the data, a sentinel read as NULL."""
    return read_csv(spark, _written_orders(spark, sf), infer=True, null_value="P")


@query(
    "csv_sep_cast",
    """SELECT o_orderkey::DOUBLE AS o_orderkey, o_custkey::DOUBLE AS o_custkey, o_orderstatus, o_totalprice,
       o_orderpriority FROM orders""",
)
def csv_sep_cast(spark, sf):
    """Header and another separator, read as text, numbers cast afterwards."""
    path = _written_orders(spark, sf, header=True, sep=";")
    numbers = dict.fromkeys(["o_orderkey", "o_custkey", "o_totalprice"], "double")
    return read_csv(spark, path, header=True, sep=";", cast_to=numbers)


#: Files that one task writes, about: a small file costs its task some ten milliseconds.
FILES_PER_TASK = 500


def _dealt_vectors(spark, sf):
    rows = table(spark, sf, "embeddings").select("vec_id", "label")
    return dealt(rows, ["vec_id"], partitions_for(rows, FILES_PER_TASK))


def _class_folders(spark, sf) -> str:
    """One small file per vector, below a folder per class."""
    path = scratch_path(spark, "classes")
    rows = _dealt_vectors(spark, sf).select(F.col("vec_id").cast("string").alias("value"), F.col("label").alias("class"))
    rows.write.partitionBy("class").option("maxRecordsPerFile", 1).text(path)
    return path


@query(
    "list_files",
    """SELECT 'class=' || label AS folder, count(*) AS n_files, sum(length(vec_id::VARCHAR) + 1)::BIGINT AS bytes
       FROM embeddings GROUP BY label""",
)
def list_files_query(spark, sf):
    files = list_files(spark, _class_folders(spark, sf), "*.txt")
    folder = F.element_at(F.split("path", "/"), -2)
    return files.groupBy(folder.alias("folder")).agg(F.count("*").alias("n_files"), F.sum("length").alias("bytes"))


@query("preview_lines")
def preview_lines_query(spark, sf):
    return preview_lines(spark, _written_orders(spark, sf), 20)


@query(
    "image_folder",
    "SELECT vec_id::VARCHAR AS content, 'class=' || label AS class_name, label FROM embeddings",
)
def image_folder(spark, sf):
    """Labelled folder: the class id is the position of the folder among the sorted names."""
    path = _class_folders(spark, sf)
    names = class_names(spark, path, "*.txt")
    rows = read_image_folder(spark, path, decode=False, pattern="*.txt", names=names)
    content = F.btrim(F.col("image").cast("string"), F.lit("\n"))
    return rows.select(content.alias("content"), "class_name", "label")


_BMP_SIZES = {"width": "vec_id % 5 + 1", "height": "vec_id % 3 + 1", "shade": "vec_id % 90 + 20"}


@query(
    "image_decoded",
    f"""SELECT label, nChannels, count(*) AS n, sum(width)::BIGINT AS width, sum(height)::BIGINT AS height,
        sum(3 * width * height)::BIGINT AS bytes, sum(shade)::BIGINT AS shade
    FROM (SELECT label, 3 AS nChannels, {", ".join(f"{e} AS {c}" for c, e in _BMP_SIZES.items())} FROM embeddings)
    GROUP BY label, nChannels""",
)
def image_decoded(spark, sf):
    """Decoded pictures of a labelled folder: one plain bitmap for every vector, its size and shade from the id.

    All bytes of these bitmaps are below 128 (54 of header and 48 of pixels at most), so the text sink can write them.
    """
    path = scratch_path(spark, "bitmaps")
    rows = _dealt_vectors(spark, sf)
    rows = rows.select(F.col("label").alias("class"), *[F.expr(e).cast("int").alias(c) for c, e in _BMP_SIZES.items()])
    number = lambda c: F.concat(F.char(c), F.lit("\0\0\0"))
    size = (4 * F.ceil(3 * F.col("width") / 4) * F.col("height")).cast("int")  # lines end at multiples of four bytes
    header = F.concat(
        F.lit("BM"), number(size + 54), F.lit("\0" * 4), number(F.lit(54)), number(F.lit(40)), number(F.col("width")),
        number(F.col("height")), F.lit("\x01\0\x18\0" + "\0" * 24),
    )
    pixels = F.repeat(F.char("shade"), size)
    bitmaps = rows.select(F.concat(header, pixels).alias("value"), "class")
    bitmaps.write.partitionBy("class").option("maxRecordsPerFile", 1).text(path)

    names = class_names(spark, path, "*.txt")
    pictures = read_image_folder(spark, path, pattern="*.txt", names=names)
    shade = F.conv(F.hex(F.substring("image.data", 1, 1)), 16, 10).cast("long")
    totals = {"width": F.col("image.width"), "height": F.col("image.height"), "bytes": F.length("image.data"), "shade": shade}
    return pictures.groupBy("label", "image.nChannels").agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(e).alias(c) for c, e in totals.items()]
    )


@query("csv_labels", "SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 0 END AS status FROM orders")
def csv_labels(spark, sf):
    """Headerless CSV to renamed columns to a mapped 0/1 label."""
    raw = read_csv(spark, _written_orders(spark, sf), schema="o_orderkey long, c1 string, c2 string, c3 string, c4 string")
    return raw.select("o_orderkey", map_value("c2", {"F": 1, "O": 0}).alias("status"))
