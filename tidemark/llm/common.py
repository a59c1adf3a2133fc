"""Helpers shared by the operators of this subpackage."""

import os
import tempfile
import zipfile

from pyspark.sql import functions as F

from tidemark.session import new_folder

#: Broadcasts are allowed up to this many measured bytes; beyond it the same join shuffles.
BROADCAST_BYTES = 32 * 1024 * 1024


def keyed(docs, id_col="doc_id", text_col="text"):
    """(id, mark, text) of every row: the id, a hash of the text and the text (null: empty).

    Rows that repeat both id and text are one document to the operators: they get the same result each.
    Rows that repeat the id with another text are told apart by the mark. No other column is looked at, so
    extra columns of any name can't clash.
    """
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    return docs.select(docs[id_col].alias("id"), F.xxhash64(text).alias("mark"), text.alias("text"))


def same_document(left, right):
    """Join condition on (id, mark); a null id equals a null id."""
    return left["id"].eqNullSafe(right["id"]) & (left["mark"] == right["mark"])


def stored(df, name):
    """df written to the shared folder and read again: computed once, and safe when executors are lost."""
    folder = new_folder(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def bounded_broadcast(df, n_rows, row_bytes, limit=BROADCAST_BYTES):
    """df marked for broadcast if its counted rows fit the limit, else df as it is (a shuffled join follows)."""
    return F.broadcast(df) if n_rows * row_bytes <= limit else df


def ascii_lower(column):
    """A-Z lower-cased, nothing else. Plain lower() does just that to text of ASCII only, and is faster."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.when(F.octet_length(column) == F.length(column), F.lower(column)).otherwise(F.translate(column, upper, lower))


def crc32_of(column):
    """crc32 of the value written as text."""
    return F.crc32(column.cast("string").cast("binary"))


def ship(context):
    """Give the executors this package, as spark-submit --py-files does; once in a Spark context."""
    if getattr(context, "_tidemark_shipped", False):
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    if package.endswith("tidemark") and os.path.isdir(package):
        target = os.path.join(tempfile.mkdtemp(prefix="tidemark-"), "tidemark.zip")
        with zipfile.ZipFile(target, "w") as archive:
            for folder, _, names in os.walk(package):
                for name in sorted(names):
                    if name.endswith(".py"):
                        path = os.path.join(folder, name)
                        archive.write(path, os.path.relpath(path, os.path.dirname(package)))
        context.addPyFile(target)
    context._tidemark_shipped = True


def in_arrow(df, function, schema):
    """df.mapInArrow on executors that have this package."""
    ship(df.sparkSession.sparkContext)
    return df.mapInArrow(function, schema)
