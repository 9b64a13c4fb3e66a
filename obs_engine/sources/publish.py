"""Replacing files of a table so that a stop at any point leaves no half of it.

New files are written to a hidden folder inside the table. When they are whole a mark is set,
and only then the table is touched: by renames, each of which can be repeated. What a stop
leaves behind is either a table as it was, or a marked folder that the next writer publishes.
"""

from __future__ import annotations

import json
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession

HIDDEN = "_publish"
# The columns of a table, where not all of its files have them all.
COLUMNS = "_columns"
# Which batch a table has taken last.
TOKEN = "_token"
# Renames wait for the file system, not for this process.
RENAMES_AT_ONCE = 16


def location(spark: SparkSession, path: str):
    """The file system of a path and the path in it."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def entries(spark: SparkSession, path: str) -> dict[str, bool]:
    """Names of what a folder holds beside hidden entries, and whether they are folders."""
    files, place = location(spark, path)
    if not files.exists(place):
        return {}
    found = ((e.getPath().getName(), e.isDirectory()) for e in files.listStatus(place))
    return {name: folder for name, folder in found if not name.startswith(("_", "."))}


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file that is there as a whole or not at all."""
    files, place = location(spark, f"{path}.part")
    stream = files.create(place, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    rename(spark, f"{path}.part", path)


def read_text(spark: SparkSession, path: str) -> str:
    files, place = location(spark, path)
    stream = files.open(place)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def delete(spark: SparkSession, path: str) -> None:
    files, place = location(spark, path)
    files.delete(place, True)


def exists(spark: SparkSession, path: str) -> bool:
    files, place = location(spark, path)
    return files.exists(place)


def rename(spark: SparkSession, source: str, target: str) -> None:
    files, place = location(spark, source)
    _, goal = location(spark, target)
    if not files.rename(place, goal):
        raise OSError(f"{source} could not be renamed to {target}")


def prepared(spark: SparkSession, path: str) -> str:
    """The folder to write new files of a table to: ``rows`` in it replace, ``added`` add.

    What an interrupted writer had completed is published first, what it had not is gone.
    """
    finish(spark, path)
    delete(spark, f"{path}/{HIDDEN}")
    return f"{path}/{HIDDEN}"


def publish(
    spark: SparkSession,
    path: str,
    drop: list[str] = (),
    columns: str | None = None,
    token: str | None = None,
) -> None:
    """Put the prepared files in their place, and take away the entries to ``drop``.

    A folder in ``rows`` replaces the one of the same name, files of ``added`` go beside
    those that are there. ``columns`` becomes the text of ``COLUMNS``, which is taken away
    if it is empty and left as it is if it is None; ``token`` that of ``TOKEN``, if given.
    """
    fresh = entries(spark, f"{path}/{HIDDEN}/rows")
    gone = [name for name in drop if name not in fresh]
    write_text(spark, f"{path}/{HIDDEN}/complete", json.dumps({"drop": gone, "columns": columns, "token": token}))
    finish(spark, path)


def finish(spark: SparkSession, path: str) -> None:
    """Publish what is marked as complete; without a mark there is nothing to do."""
    mark = f"{path}/{HIDDEN}/complete"
    if not exists(spark, mark):
        return
    rows, added = f"{path}/{HIDDEN}/rows", f"{path}/{HIDDEN}/added"
    plan = json.loads(read_text(spark, mark))
    for name, text in ((COLUMNS, plan["columns"]), (TOKEN, plan["token"])):
        if text is not None:
            delete(spark, f"{path}/{name}")
        if text:
            write_text(spark, f"{path}/{name}", text)

    def replace(name: str) -> None:
        delete(spark, f"{path}/{name}")
        rename(spark, f"{rows}/{name}", f"{path}/{name}")

    def add(name: str) -> None:
        # A task that wrote rows of both kinds gave both files one name.
        folder, _, file = name.rpartition("/")
        rename(spark, f"{added}/{name}", f"{path}/{folder}/added-{file}" if folder else f"{path}/added-{file}")

    with ThreadPoolExecutor(RENAMES_AT_ONCE) as pool:
        list(pool.map(lambda name: delete(spark, f"{path}/{name}"), plan["drop"]))
        list(pool.map(replace, entries(spark, rows)))
        single = []
        for name, folder in entries(spark, added).items():
            if folder:
                files, place = location(spark, f"{path}/{name}")
                files.mkdirs(place)
                single += [f"{name}/{file}" for file in entries(spark, f"{added}/{name}")]
            else:
                single.append(name)
        list(pool.map(add, single))
    delete(spark, mark)
    delete(spark, f"{path}/{HIDDEN}")
