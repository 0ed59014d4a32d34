"""Category reference documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendlake import schemas
from trendlake.functions.columns import quoted
from trendlake.functions.values import region_of_path
from trendlake.sources.documents import (
    CORRUPT,
    FILE_TIME,
    SOURCE_FILE,
    read_documents,
    unreadable,
)

POSITION = "_position"
LANDED_AT = "_landed_at"


def with_region(documents: DataFrame) -> DataFrame:
    """Region from the file's path, as loose files outside ``region=`` folders count too."""
    return documents.withColumn(
        "region", region_of_path(F.col(SOURCE_FILE), schemas.UNKNOWN_REGION)
    )


def category_items(documents: DataFrame) -> DataFrame:
    """One row per category, with its position in the document and the time the document landed:
    that of its envelope, else of its file.

    A document without an ``items`` list counts as a single category.
    """
    fields = documents.schema["items"].dataType.elementType.names
    itself = F.array(F.struct(*(quoted(name) for name in fields)))
    readable = documents.filter(~unreadable(documents))
    landed = F.col(FILE_TIME)
    if "_pipeline_metadata" in documents.columns:
        landed = F.coalesce(F.try_to_timestamp(F.col("_pipeline_metadata.ingestion_timestamp")), landed)
    file_columns = ["region", SOURCE_FILE, LANDED_AT]
    return readable.withColumn(LANDED_AT, landed).select(
        *file_columns, F.posexplode(F.coalesce("items", itself)).alias(POSITION, "item")
    ).select("item.*", *file_columns, POSITION)


def category_schema(spark: SparkSession, path: str, layout: str = "files") -> T.StructType:
    """The schema of category documents with the fields that items below ``path`` have besides the declared ones.

    One aggregate over the items; only the merged schema reaches the driver. Values of such fields are kept as text, lists and
    fields of several types as JSON, so that a column's type stays the same whatever files come later. A field whose
    column would have the name of another one, in any case of letters, is left out. Of a document that is itself a
    category only the snippet's fields are looked at.
    """
    texts = T.StructType().add("items", T.ArrayType(T.StringType())).add("snippet", "string").add(CORRUPT, "string")
    documents = read_documents(spark, path, texts, folders=None, layout=layout)
    itself = F.array(F.concat(F.lit('{"snippet":'), "snippet", F.lit("}")))
    items = documents.select(F.explode(F.coalesce("items", itself)).alias("item"))
    objects = items.where(F.col("item").rlike(r"^\s*\{"))
    found = objects.agg(F.schema_of_variant_agg(F.try_parse_json("item")).alias("found")).first()["found"]
    declared = schemas.CATEGORY_DOCUMENT["items"].dataType.elementType
    if not found.startswith("OBJECT<"):
        return schemas.CATEGORY_DOCUMENT
    taken = {name.lower() for name in (*schemas.CLEAN_REFERENCE.names, POSITION)}
    item = with_more_fields(declared, T.DataType.fromDDL(found.replace("OBJECT<", "STRUCT<")), taken)
    top = [item[f.name] if f.name in item.names else f for f in schemas.CATEGORY_DOCUMENT.fields if f.name != "items"]
    names = {field.name.lower() for field in schemas.CATEGORY_DOCUMENT.fields}
    item = T.StructType([f for f in item.fields if f.name in declared.names or f.name.lower() not in names])
    more = [f for f in item.fields if f.name not in declared.names]
    return T.StructType([*top, *more, T.StructField("items", T.ArrayType(item))])


def with_more_fields(
    known: T.StructType, found: T.StructType, taken: set[str], path: tuple[str, ...] = ()
) -> T.StructType:
    """``known`` and the fields that only ``found`` has, as text; ``taken`` are the flattened names in use, in lower case."""
    fields = []
    for field in known.fields:
        both = field.name in found.names and isinstance(field.dataType, T.StructType)
        if both and isinstance(found[field.name].dataType, T.StructType):
            kind = with_more_fields(field.dataType, found[field.name].dataType, taken, (*path, field.name))
            field = T.StructField(field.name, kind)
        fields.append(field)
    names = {field.name.lower() for field in fields}
    for field in found.fields:
        if field.name.lower() in names:
            continue
        names.add(field.name.lower())
        if isinstance(field.dataType, T.StructType):
            kind = with_more_fields(T.StructType(), field.dataType, taken, (*path, field.name))
            if kind.fields:
                fields.append(T.StructField(field.name, kind))
            continue
        column = "_".join((*path, field.name)).lower()
        if column not in taken:
            taken.add(column)
            fields.append(T.StructField(field.name, T.StringType()))
    return T.StructType(fields)


def read_category_documents(spark: SparkSession, path: str, layout: str = "files") -> DataFrame:
    schema = category_schema(spark, path, layout)
    return with_region(read_documents(spark, path, schema, folders=None, layout=layout))


def read_categories(spark: SparkSession, path: str) -> DataFrame:
    return category_items(read_category_documents(spark, path))
