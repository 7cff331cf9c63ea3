"""File readers (SRC-1..7). Schemas are explicit except where inference is the
feature being offered (``read_csv(infer=True)``, ``read_json_lines`` without a
schema)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per line: ``value STRING`` (SRC-1)."""
    return spark.read.text(path)


def read_whole_files(spark: SparkSession, path: str, nested: bool = False) -> DataFrame:
    """One row per file: ``(path STRING, text STRING)`` (SRC-2 input). ``nested``: files
    of all folders below, whose names are not taken for partition values."""
    return (spark.read.schema("value string").option("recursiveFileLookup", nested).text(path, wholetext=True)
            .select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text")))


def _fs(path: str):
    """(file system of pyarrow, its path) for a path in shared storage."""
    from pyarrow import fs
    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


FOLDERS = 256


def write_whole_files(docs: DataFrame, path: str, name_col: str, text_col: str, folders: int = FOLDERS) -> DataFrame:
    """Write one file per row and return the stored table of their paths, (path).

    Tasks write the files, named ``doc=<name>@<place of the row>.txt``, into ``folders``
    folders by a hash of the row. A path enters the table when its task has
    succeeded; a task that is run again writes the same files again. A null
    text is an empty file."""
    import pyarrow as pa
    rows = docs.select(F.col(name_col).cast("string").alias("name"), F.monotonically_increasing_id().alias("place"),
                       F.col(text_col).cast("binary").alias("text"))
    base = path.rstrip("/")

    def write(batches):
        fs, root = _fs(base)
        made = set()
        for b in batches:
            paths = []
            for name, place, text in zip(*(c.to_pylist() for c in b.columns)):
                # consecutive rows of a task go to different folders
                folder = f"h={(place * 0x9E3779B1 >> 16) % folders:03x}"
                if folder not in made:
                    fs.create_dir(f"{root}/{folder}", recursive=True)
                    made.add(folder)
                leaf = f"{folder}/doc={'' if name is None else name}@{place}.txt"
                with fs.open_output_stream(f"{root}/{leaf}") as f:
                    f.write(text or b"")
                paths.append(f"{base}/{leaf}")
            yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string())], ["path"])

    table = base + "-paths"
    rows.mapInArrow(write, "path string").write.parquet(table)
    return docs.sparkSession.read.schema("path string").parquet(table)


def read_listed_files(paths: DataFrame, tasks: int | None = None, path_col: str = "path") -> DataFrame:
    """One row per listed file: (path, text), as ``read_whole_files`` but without a listing
    by the driver: the paths are a table, dealt to ``tasks`` tasks (as many as the
    table has splits if None), and each task opens its own files. Bytes that are not
    UTF-8 become replacement characters."""
    import pyarrow as pa
    d = paths.select(F.col(path_col).alias("path"))

    def read(batches):
        fs = None
        for b in batches:
            found, texts, size = [], [], 0
            for p in b.column(0).to_pylist():
                fs, own = (fs, _fs(p)[1]) if fs else _fs(p)
                with fs.open_input_stream(own) as f:
                    texts.append(f.read().decode("utf-8", "replace"))
                found.append(p)
                size += len(texts[-1])
                if size > 8 << 20:  # large files come back in small batches
                    yield pa.RecordBatch.from_arrays([pa.array(found, pa.string()), pa.array(texts, pa.string())], ["path", "text"])
                    found, texts, size = [], [], 0
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.string()), pa.array(texts, pa.string())], ["path", "text"])

    return (d.repartition(tasks) if tasks else d).mapInArrow(read, "path string, text string")


def read_csv(spark: SparkSession, path: str, header: bool = True, infer: bool = False,
             schema: T.StructType | str | None = None, names=None, sep: str = ",") -> DataFrame:
    """CSV with a header (SRC-3) or without one, columns named by position (SRC-4).

    Inference costs an extra pass over the data; give a schema at scale.
    """
    r = spark.read.option("header", header).option("sep", sep)
    if schema is not None:
        r = r.schema(schema)
    elif infer:
        r = r.option("inferSchema", True)
    df = r.csv(path)
    if names:
        df = df.toDF(*names)
    return df


def read_json_lines(spark: SparkSession, path: str,
                    schema: T.StructType | None = None) -> DataFrame:
    """JSON lines; a malformed line becomes a row with ``_corrupt_record`` set
    and the read goes on (SRC-5). Without a schema one inference pass runs
    first. Lines are read as text and parsed with ``from_json``, so the
    corrupt column is an ordinary column: counting or selecting it alone
    needs no cache (a raw JSON scan refuses such queries). Blank lines are
    skipped, as the JSON reader does."""
    if schema is None:
        schema = spark.read.json(path).schema
    fields = [f for f in schema.fields if f.name != CORRUPT]
    full = T.StructType(fields + [T.StructField(CORRUPT, T.StringType())])
    opts = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    lines = spark.read.text(path).where(F.trim(F.col("value")) != "")
    return lines.select(F.from_json(F.col("value"), full, opts).alias("_j")).select("_j.*")


def split_corrupt(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows without the corrupt column, rejected rows) (SRC-6)."""
    if CORRUPT not in df.columns:
        return df, df.limit(0)
    good = df.where(F.col(CORRUPT).isNull()).drop(CORRUPT)
    bad = df.where(F.col(CORRUPT).isNotNull())
    return good, bad


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """SRC-7."""
    return spark.read.parquet(path)
