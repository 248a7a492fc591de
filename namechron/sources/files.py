"""Sources and sinks of the tables: numbered page files, CSV, TSV and reader answers.

All columns are read as text, and an empty field is an empty text, never null.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Mapping

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import patterns as P
from ..functions.text import clean_lines, extract, join_lines, matches, text_or_empty, trim_u
from ..operators.overlay import OverlayError
from ..schemas import OVERLAY, STAGES, STREETS

_CSV = {"header": True, "quote": '"', "escape": '"', "multiLine": True}


def pages(spark: SparkSession, folder: str, volume: str = "") -> DataFrame:
    """volume, page and text of files ``sNNN.txt``; bytes that are no UTF-8 become U+FFFD.

    The volume is ``volume`` or, if that is empty, the path of the folder that a file lies in;
    ``folder`` may be a pattern for the folders of many volumes.
    """
    raw = spark.read.format("binaryFile").option("pathGlobFilter", "s*.txt").load(folder)
    number = extract(F.col("path"), r"/s+(\d+)\.txt$", 1).cast("int")
    name = F.lit(volume) if volume else F.regexp_replace("path", "/[^/]*$", "")
    return raw.select(name.alias("volume"), number.alias("page"), F.make_valid_utf8(F.col("content").cast("string")).alias("text"))


def clean_pages(df: DataFrame, running_title: str = "") -> DataFrame:
    """Pages without furniture, each as one line; a narrow step."""
    return df.withColumn("text", join_lines(clean_lines("text", running_title)))


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None, sep: str = ",", ordered: bool = False) -> DataFrame:
    """CSV files with a header, as text columns; ``schema`` fixes names and casts whole numbers, ``ordered`` adds ``seq``."""
    reader = spark.read.options(**_CSV, sep=sep)
    if schema is not None:
        reader = reader.schema(T.StructType([T.StructField(f.name, T.StringType()) for f in schema])).option("enforceSchema", False)
    df = reader.csv(path)
    kinds = {f.name: f.dataType for f in schema or []}
    columns = [F.col(c).try_cast(kinds[c]).alias(c) if c in kinds else F.col(c) for c in df.columns]
    if not ordered:
        return df.na.fill("").select(*columns)
    return _with_seq(df).na.fill("", df.columns).select(*columns, "seq")


def load_version(spark: SparkSession, source: str | tuple) -> tuple[DataFrame, DataFrame]:
    """(streets, stages) of a version, with their order as ``seq``: a folder with the files of both, or a pair of tables.

    A table is a DataFrame (streets with ``seq``; stages go by their numbers), a list of rows, or a mapping from keys to a row or to a list of
    rows. Rows are mappings; what they lack is an empty text, a number that can't be read is null.
    """
    if isinstance(source, str):
        return read_csv(spark, f"{source}/streets", STREETS, ordered=True), read_csv(spark, f"{source}/stages", STAGES, ordered=True)
    streets, stages = source
    if isinstance(streets, DataFrame) and "seq" not in streets.columns:
        raise ValueError("streets need seq, the order of their rows")
    return _given(spark, streets, STREETS), _given(spark, stages, STAGES)


def _given(spark: SparkSession, rows: DataFrame | Mapping | list, schema: T.StructType) -> DataFrame:
    if isinstance(rows, DataFrame):
        return rows
    if isinstance(rows, Mapping):
        rows = [r for of_key in rows.values() for r in ([of_key] if isinstance(of_key, Mapping) else of_key)]
    texts = [[*("" if r.get(c) is None else str(r[c]) for c in schema.names), i] for i, r in enumerate(rows)]
    made = spark.createDataFrame(texts, T.StructType([T.StructField(c, T.StringType()) for c in schema.names]).add("seq", T.LongType()))
    return made.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema], "seq")


#: Folders of corrections that were appended, numbered in the order in which they were committed.
_APPENDED = r"/append-(\d+)/[^/]*$"


def _with_seq(raw: DataFrame) -> DataFrame:
    """Rows as read from files with ``seq``, their order: what was appended after what was there, by its number; then by file name, rows as in the file.

    A file's rows stand in one partition, in order (records may hold line ends, so files aren't
    split). The order of files is a small table; no row is sorted. Names alone count, so copies keep it.
    """
    row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    marked = raw.select("*", F.col("_metadata.file_path").alias("_file"), row.alias("_row"))
    number = F.coalesce(F.try_to_number(extract("_file", _APPENDED), F.lit("9" * 18)).cast("long"), F.lit(0))
    place = marked.select("_file").distinct().select("_file", F.row_number().over(Window.orderBy(number, "_file")).cast("long").alias("_place"))  # a row for each file
    return marked.join(F.broadcast(place), "_file").withColumn("seq", F.col("_place") * F.lit(1 << 33) + F.col("_row")).drop("_file", "_row", "_place")


def append_corrections(df: DataFrame, path: str, order: list | None = None) -> int:
    """Commit rows of corrections behind those that ``path`` holds, and give the number of their folder.

    They are written aside and then take the first free number by a rename that fails if another run
    has taken it meanwhile, so each append is there as a whole or not at all.
    """
    spark = df.sparkSession
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    aside = f"{path}/.new-{uuid.uuid4().hex}"
    write_csv(df, aside, OVERLAY, order)
    source = jvm.org.apache.hadoop.fs.Path(aside)
    store = jvm.org.apache.hadoop.fs.FileContext.getFileContext(source.toUri(), conf)
    names = (s.getPath().getName() for s in source.getFileSystem(conf).listStatus(source.getParent()))
    number = 1 + max((int(n.removeprefix("append-")) for n in names if re.fullmatch(r"append-\d+", n)), default=0)
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    while True:
        try:
            store.rename(source, jvm.org.apache.hadoop.fs.Path(f"{path}/append-{number:018d}"), options)
            return number
        except Py4JJavaError as e:
            if "FileAlreadyExists" not in e.java_exception.getClass().getName():
                raise
            number += 1


def write_csv(df: DataFrame, path: str, schema: T.StructType, order: list | None = None, mode: str = "overwrite", one_file: bool = True) -> None:
    """The columns of ``schema`` in their order; other columns are left out.

    The published tables are small and each is one file; with ``one_file`` off every partition
    writes its own, in the order of the file names.
    """
    rows = (df.orderBy(*order) if order else df).select(*schema.names)
    rows = rows.coalesce(1) if one_file else rows
    rows.write.mode(mode).option("header", True).option("quote", '"').option("escape", '"').option("emptyValue", "").option("nullValue", "").csv(path)


def register_names(df: DataFrame, column: str = "strasse") -> DataFrame:
    return df.select(trim_u(column).alias("strasse")).where("strasse <> ''").distinct()


def address_book_names(df: DataFrame, column: str = "Adresse") -> DataFrame:
    """Distinct street names of an address column: what comes before the house number."""
    address = trim_u(text_or_empty(column))
    name = trim_u(F.when(matches(address, P.STREET_OF_ADDRESS), extract(address, P.STREET_OF_ADDRESS)).otherwise(address))
    return df.select(name.alias("name")).where("name <> ''").distinct()


def exists(spark: SparkSession, path: str) -> bool:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)


def read_overlay(spark: SparkSession, path: str) -> DataFrame:
    """Corrections with ``seq``, their order: appended ones by number, then files by name, then rows; none if there is no file, an error if their columns are others."""
    if not exists(spark, path):
        return spark.createDataFrame([], OVERLAY).withColumn("seq", F.lit(0).cast("long"))
    df = spark.read.options(**_CSV).option("recursiveFileLookup", True).csv(path)
    if df.columns != OVERLAY.names:
        raise OverlayError(f"expected columns {OVERLAY.names}, found {df.columns}")
    return _with_seq(df).na.fill("", OVERLAY.names)


def read_answers(spark: SparkSession, folder: str, readers: dict[str, str]) -> DataFrame:
    """Answers of readers (short name -> folder name) below ``folder``; a broken file is an error that names it."""
    out = None
    for reader, name in readers.items():
        raw = spark.read.text(f"{folder}/{name}/s*.json", wholetext=True).select(F.lit(reader).alias("reader"), F.input_file_name().alias("path"), "value")
        fields = F.from_json("value", "buchseite string, modell string, zeitstempel string, prompt_hash string, rohtext string, fehler string, eintraege string")
        broken = F.try_parse_json("value").isNull()
        checked = F.when(broken, F.raise_error(F.concat(F.lit("answer file can't be read: "), F.col("path")))).otherwise(extract(F.col("path"), r"/s+(\d+)\.json$", 1).cast("int"))
        df = raw.select("reader", checked.alias("buchseite"), fields.alias("f")).select("reader", "buchseite", "f.prompt_hash", "f.fehler", F.when(F.col("f.eintraege") != "null", F.col("f.eintraege")).alias("eintraege"))
        out = df if out is None else out.unionByName(df)
    if out is None:
        raise FileNotFoundError(f"no known reader below {folder}")
    return out


def find_readers(spark: SparkSession, folder: str, short_names: list[str]) -> dict[str, str]:
    """Short name -> folder name of the folders below ``folder`` whose name holds a short name."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    store = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = sorted(s.getPath().getName() for s in store.listStatus(place) if s.isDirectory())
    return {short: n for n in names for short in short_names if short in n.lower()}


def open_corrections(review: DataFrame) -> bool:
    """Whether a review list holds filled cells that a new one would overwrite."""
    return bool(review.where(trim_u(text_or_empty("korrektur")) != "").limit(1).count())


