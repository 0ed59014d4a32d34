"""JSON documents in the raw zone, as batches or as file streams.

Files of any name and of the usual extensions, compressed or not, are read. What a file holds is told by
its content: one document, indented or not, a list of documents, or one document per line. A file is
read by one task then. A tree that is known to hold lines only, such as one of large landed files, can be
declared as such (``layout="lines"``); its files are split over tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendlake.schemas import CORRUPT, TEXT, TIME, struct

SOURCE_FILE = "_source_file"
FILE_TIME = "_file_time"
FILE_SIZE = "_file_size"
FILE_COLUMNS = struct(_source_file=TEXT, _file_time=TIME)

# The extensions of raw files, how they may be compressed, and the landing folders.
DOCUMENT_KINDS = ("json", "jsonl", "ndjson")
BULK_KINDS = ("csv",)
COMPRESSIONS = ("", ".gz", ".bz2")
LANDING_FOLDERS = ("region", "date", "hour")

# Tasks per core that are always left, and how many partitions of Spark's packing a task takes at most.
TASKS_PER_CORE = 8
PARTITIONS_PER_TASK = 8

Watch = Callable[[DataFrame], DataFrame]


def any_case(word: str) -> str:
    """Letters as classes of both cases, in the form that file patterns and regular expressions share."""
    return "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in word)


def file_pattern(kinds: Sequence[str]) -> str:
    """Pattern for files of these kinds. A compressed file is known by its extension as it is written here."""
    return "{" + ",".join(f"*.{any_case(kind)}{packed}" for kind in kinds for packed in COMPRESSIONS) + "}"


def file_regex(kinds: Sequence[str]) -> str:
    """The same as :func:`file_pattern` for the end of a path."""
    endings = "|".join(packed.replace(".", r"\.") for packed in COMPRESSIONS)
    return rf"[^/]*\.({'|'.join(any_case(kind) for kind in kinds)})({endings})$"


DOCUMENT_GLOB = file_pattern(DOCUMENT_KINDS)


def join_schemas(*parts: T.StructType) -> T.StructType:
    return T.StructType([field for part in parts for field in part.fields])


def below(path: str, folders: Sequence[str]) -> str:
    """Pattern for the ``name=value`` folders below ``path``.

    Raw files of several kinds may share a tree at different depths, which Spark takes for
    inconsistent partitioning if it is given the root.
    """
    return "/".join([path, *(f"{name}=*" for name in folders)])


def load_if_any(reader, pattern: str | list[str]) -> DataFrame | None:
    """Load a pattern, or several; None if a batch finds no match (a stream waits for files)."""
    try:
        return reader.load(pattern)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def empty(schema: T.StructType) -> DataFrame:
    return SparkSession.active().createDataFrame([], schema)


def load_documents(
    reader,
    path: str,
    schema: T.StructType,
    folders: Sequence[str] | None,
    layout: str = "files",
    files: Sequence[str] | None = None,
    watch: Watch | None = None,
) -> DataFrame:
    """Documents through a batch or stream reader, with file name and time.

    ``folders`` names the partition columns, which filters on them can use to skip folders;
    None finds files at any depth. ``layout`` is ``files`` or ``lines``, see above. ``files``, path patterns in such folders, are
    those to read, if not all. ``watch`` sees a row per file of the ``files`` layout, with size and partition columns, before it is
    parsed, and may observe or leave out rows.
    """
    if layout not in ("files", "lines"):
        raise ValueError(f"unknown layout {layout}")
    names = [name for name in folders or () if name in schema.fieldNames()]
    own = T.StructType([field for field in schema.fields if field.name not in names])
    placed = [schema[name] for name in names]
    if layout == "lines":
        reader = (
            reader.format("json")
            .schema(schema)
            .option("columnNameOfCorruptRecord", CORRUPT)
            .option("mode", "PERMISSIVE")
        )
    else:
        reader = (
            reader.format("text")
            .schema(T.StructType([T.StructField("value", TEXT), *placed]))
            .option("wholetext", True)
        )
    reader = reader.option("pathGlobFilter", DOCUMENT_GLOB)
    if folders is None:
        loaded = load_if_any(reader.option("recursiveFileLookup", True), path)
    else:
        loaded = load_if_any(reader.option("basePath", path), below(path, folders) if files is None else list(files))
    if loaded is None:
        return empty(join_schemas(schema, FILE_COLUMNS))
    file = [
        F.col("_metadata.file_path").alias(SOURCE_FILE),
        F.col("_metadata.file_modification_time").alias(FILE_TIME),
    ]
    if layout == "lines":
        return loaded.select(*schema.fieldNames(), *file)
    loaded = in_fewer_tasks(loaded)
    # Step by step: what several expressions of a step use is a column of the step before, and computed once.
    kept = [*names, SOURCE_FILE, FILE_TIME]
    if watch is not None:
        loaded = watch(loaded.select("*", F.col("_metadata.file_size").alias(FILE_SIZE), "_metadata"))
    plain = loaded.select(without_mark(F.col("value")).alias("value"), *names, *file)
    lined = plain.select("value", text_lines(F.col("value")).alias("_lines"), *kept)
    texts = lined.select(F.explode(document_texts(F.col("value"), F.col("_lines"))).alias("value"), *kept)
    framed = texts.select("value", parse_framed(F.col("value"), own).alias("_framed"), *kept)
    parsed = framed.select(F.explode(parse(F.col("value"), F.col("_framed"), own)).alias("doc"), *kept)
    return parsed.select(
        *(F.col("doc")[name].alias(name) if name in own.fieldNames() else name for name in schema.fieldNames()),
        SOURCE_FILE,
        FILE_TIME,
    )


def in_fewer_tasks(loaded: DataFrame) -> DataFrame:
    """Files of a batch in fewer tasks. Landing leaves many small files, of which Spark packs few in a partition, as it takes each
    for some megabytes more, while starting to parse costs a task as much as thousands of documents. Files are read one at a time, so
    their number takes no more memory, and what follows spills."""
    if loaded.isStreaming:
        return loaded
    packed = loaded.rdd.getNumPartitions()
    tasks = max(TASKS_PER_CORE * loaded.sparkSession.sparkContext.defaultParallelism, -(-packed // PARTITIONS_PER_TASK))
    return loaded.coalesce(tasks) if tasks < packed else loaded


def frame(text: Column) -> Column:
    """A text inside of an object with a field behind it, which only shows if the text is one JSON value and ends there."""
    return F.concat(F.lit('{"_value":'), text, F.lit(',"_text_end":1}'))


def whole_value(text: Column) -> Column:
    """Whether a text is one JSON value with nothing left after its end, which from_json alone ignores."""
    end = F.from_json(frame(text), "_text_end int", {"mode": "PERMISSIVE"})["_text_end"]
    return F.coalesce(end == 1, F.lit(False))


def without_mark(content: Column) -> Column:
    """A file's text without byte order mark. Only text with one, or with bytes that aren't UTF-8, is made anew."""
    as_it_is = F.is_valid_utf8(content) & ~content.startswith("\uFEFF")
    return F.when(as_it_is, content).otherwise(F.regexp_replace(content, "^\uFEFF", ""))


def text_lines(plain: Column) -> Column:
    """The lines of a text that aren't blank. A split at one plain character needs no regular expression."""
    lines = F.when(plain.contains("\r"), F.split(plain, "\r?\n")).otherwise(F.split(plain, "\n"))
    return F.filter(lines, lambda line: line.startswith("{") | (F.trim(line) != ""))


def trimmed(line: Column) -> Column:
    """A line without blanks around it. Trimming reads all of a line, so one that has none is left as it is."""
    return F.when(line.startswith(" ") | line.endswith(" "), F.trim(line)).otherwise(line)


def document_texts(plain: Column, lines: Column) -> Column:
    """The documents of a file with these :func:`text_lines`: its lines if it isn't one value and a line of several is, else the whole.

    The first line counts, and any other object that isn't indented, so that a bad line costs that line only.
    """
    first = F.coalesce(F.trim(F.get(lines, F.lit(0))), F.lit(""))
    alone = (first.rlike(r"^[{\[]") & whole_value(first)) | F.exists(
        lines, lambda line: line.startswith("{") & whole_value(line)
    )
    split = (F.size(lines) > 1) & ~whole_value(plain) & alone
    return F.when(split, F.transform(lines, trimmed)).otherwise(F.array(plain))


OPTIONS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}


def parse_framed(text: Column, schema: T.StructType) -> Column:
    """A text parsed as one document inside of its frame: in one pass the document, and whether there is one and nothing else."""
    inner = T.StructType([field for field in schema.fields if field.name != CORRUPT])
    whole = struct(_value=inner, _text_end=T.IntegerType(), **{CORRUPT: TEXT})
    return F.from_json(frame(text), whole, OPTIONS)


def parse(text: Column, framed: Column, schema: T.StructType) -> Column:
    """One document or a list of them; what isn't one JSON value becomes a document with that text alone.

    ``framed`` is the text's :func:`parse_framed`, which a document without any fault is taken from. Others are parsed by themselves.
    """
    clean = (framed["_text_end"] == 1) & framed["_value"].isNotNull() & framed[CORRUPT].isNull()
    listed = F.from_json(text, T.ArrayType(schema), OPTIONS)
    single = F.array(F.from_json(text, schema, OPTIONS))

    def document(value) -> Column:
        return F.array(F.struct(*(value(field).cast(field.dataType).alias(field.name) for field in schema.fields)))

    sound = document(lambda field: F.lit(None) if field.name == CORRUPT else framed["_value"][field.name])
    broken = document(lambda field: text if field.name == CORRUPT else F.lit(None))
    other = F.when((F.trim(text) == "") | ~whole_value(text), broken).when(
        text.rlike(r"^\s*\["), F.coalesce(listed, broken)
    )
    return F.when(clean, sound).otherwise(other.otherwise(single))


def misplaced_files(spark: SparkSession, path: str, folders: Sequence[str]) -> DataFrame:
    """Files below ``path`` that aren't read: documents outside of the ``name=value`` folders, bulk files not straight
    in a region's folder, and files of any other name. Only their names are read here."""
    listed = load_if_any(spark.read.format("binaryFile").option("recursiveFileLookup", True), path)
    if listed is None:
        return empty(struct(file=TEXT))

    def filed(names: Sequence[str], kinds: Sequence[str]) -> Column:
        return F.col("file").rlike("/" + "/".join([*(f"{name}=[^/]*" for name in names), file_regex(kinds)]))

    known = filed(folders, DOCUMENT_KINDS) | filed(("region",), BULK_KINDS)
    return listed.select(F.col("path").alias("file")).where(~known)


def unreadable(documents: DataFrame) -> Column:
    """Documents that don't parse. One with a single value of another type than declared has
    its other values, and counts as readable."""
    if CORRUPT not in documents.columns:
        return F.lit(False)
    return F.col(CORRUPT).isNotNull() & F.col("items").isNull()


def read_documents(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    folders: Sequence[str] | None = LANDING_FOLDERS,
    layout: str = "files",
    files: Sequence[str] | None = None,
    watch: Watch | None = None,
) -> DataFrame:
    """All documents below ``path``, or those of some files, see :func:`load_documents`."""
    return load_documents(spark.read, path, schema, folders, layout, files, watch)


def document_files(spark: SparkSession, path: str, folders: Sequence[str]) -> DataFrame:
    """The files that :func:`load_documents` reads below ``path``, with time and size; nothing in them is read."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", DOCUMENT_GLOB).option("basePath", path)
    listed = load_if_any(reader, below(path, folders))
    if listed is None:
        return empty(join_schemas(FILE_COLUMNS, struct(_file_size=T.LongType())))
    return listed.select(
        F.col("_metadata.file_path").alias(SOURCE_FILE),
        F.col("_metadata.file_modification_time").alias(FILE_TIME),
        F.col("_metadata.file_size").alias(FILE_SIZE),
    )
