"""Small text files of a job's own: claims, indexes and manifests."""

import os
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def store(spark: SparkSession, path):
    """A path and the file system that holds it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path) -> bool:
    place, files = store(spark, path)
    return files.exists(place)


def put(spark: SparkSession, path, text):
    """Write a file, in place of an earlier one."""
    place, files = store(spark, path)
    out = files.create(place, True)
    out.write(bytearray(text.encode()))
    out.close()


def get(spark: SparkSession, path) -> str:
    """The text of a file."""
    return spark.read.text(path, wholetext=True).first()[0]


def create_once(spark: SparkSession, path, text) -> bool:
    """Create a file with its whole content; False if it was there before.

    The content is written to a name of its own first and then put in place
    without overwriting.  That last step is one step on HDFS and on local
    disks; a store without it can have one writer only.
    """
    place, files = store(spark, path)
    draft_path = f"{place.getParent().getParent()}/drafts/{uuid.uuid4().hex}"
    put(spark, draft_path, text)
    draft, _ = store(spark, draft_path)
    files.mkdirs(place.getParent())
    try:
        if files.getScheme() == "file":
            os.link(draft.toUri().getPath(), place.toUri().getPath())
            return True
        return rename_once(spark, draft, place)
    except FileExistsError:
        return False
    finally:
        files.delete(draft, False)


def rename_once(spark: SparkSession, draft, place) -> bool:
    """Rename unless the new name is taken; whether it was done."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    context = hadoop.FileContext.getFileContext(draft.toUri(), spark._jsc.hadoopConfiguration())
    rename = getattr(hadoop, "Options$Rename")
    options = spark._sc._gateway.new_array(rename, 1)
    options[0] = rename.NONE
    try:
        context.rename(draft, place, options)
        return True
    except Py4JJavaError:
        if context.util().exists(place):
            return False
        raise
