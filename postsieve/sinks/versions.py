"""Replace datasets of an output folder so that a reader finds all of the old state or all of the new.

A dataset that was written once is a folder of files.  One that was replaced has a folder
``version=<n>`` and beside it an empty file ``_committed-<n>``, whose creation is the one step that
counts: until then readers take what was there before, from then on the new version.  Whatever a
lost driver leaves behind is not read, and goes when the dataset is replaced again.  One writer at a
time may replace a dataset.
"""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postsieve.sources.folders import create_file, delete_folder, entry_names, folder_names, move_folder

_VERSION, _MARK, _SITE = "version=", "_committed-", "dataset="


def _numbers(names: Sequence[str], prefix: str) -> list[int]:
    numbers = [name.removeprefix(prefix) for name in names if name.startswith(prefix)]
    return sorted(int(number) for number in numbers if number.isdigit())


def publish(spark: SparkSession, staged: str, output_dir: str, sites: Sequence[str] = ()) -> None:
    """Make ``staged/dataset=<name>`` the datasets' content, one after the other.

    ``sites`` that have nothing staged lose what they had.
    """
    new = folder_names(spark, staged)
    gone = [name for name in folder_names(spark, output_dir) if unquote(name).removeprefix(_SITE) in sites and name not in new]
    for name in [*new, *gone]:
        folder = f"{output_dir}/{name}"
        names = entry_names(spark, folder)
        number = 1 + max([0, *_numbers(names, _VERSION), *_numbers(names, _MARK)])
        if name in new:
            move_folder(spark, f"{staged}/{name}", f"{folder}/{_VERSION}{number}")
        commit(spark, folder, number)
        for old in names:
            delete_folder(spark, f"{folder}/{old}")
        if name not in new:
            delete_folder(spark, folder)


def commit(spark: SparkSession, folder: str, number: int) -> None:
    """The version holds from here on; with no folder of its own, the dataset is empty."""
    create_file(spark, f"{folder}/{_MARK}{number}")


def current_paths(spark: SparkSession, output_dir: str) -> list[str]:
    """Files and folders that hold what the datasets are now."""
    out = []
    for site in folder_names(spark, output_dir):
        folder = f"{output_dir.rstrip('/')}/{site}"
        names = entry_names(spark, folder)
        committed = _numbers(names, _MARK)
        if committed:
            version = f"{_VERSION}{committed[-1]}"
            out += [f"{folder}/{version}"] if version in names else []
        elif any(name.startswith(_VERSION) for name in names):
            out += [f"{folder}/{name}" for name in names if name[0] not in "._" and not name.startswith(_VERSION)]
        else:
            out.append(folder)
    return out


def read_json_text(spark: SparkSession, output_dir: str) -> DataFrame:
    """``(dataset, value)``: the lines of all datasets as they are now, without empty ones."""
    paths = current_paths(spark, output_dir)
    if not paths:
        return spark.createDataFrame([], "dataset STRING, value STRING")
    lines = spark.read.option("lineSep", "\n").option("recursiveFileLookup", "true").text(paths)
    folder = F.regexp_extract(F.col("_metadata.file_path"), f"/{_SITE}([^/]+)/", 1)
    # File paths are encoded once more than the folder's name is.
    name = F.url_decode(F.replace(F.url_decode(F.replace(folder, F.lit("+"), F.lit("%2B"))), F.lit("+"), F.lit("%2B")))
    value = F.trim("value")
    return lines.select(name.alias("dataset"), value.alias("value")).where("value <> ''")
