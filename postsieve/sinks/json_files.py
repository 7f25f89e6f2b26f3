"""Write records as JSON text, one value ``[post_id, {...}]`` per post.

Output goes to ``<output_dir>/dataset=<name>/`` with Spark's own file names.  What was replaced has
a folder more in the path, see ``versions.py``; ``read_json_text`` there reads either.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postsieve.sinks.versions import publish
from postsieve.sources.folders import delete_folder

# Fixed value: non-ASCII characters are written as \uXXXX escapes, and a NULL
# field is written rather than left out.
_JSON_OPTIONS = {"ignoreNullFields": "false", "writeNonAsciiCharacterAsCodePoint": "true"}


def record_json() -> Column:
    """JSON text of one record."""
    body = F.to_json(F.struct("score", "text_blocks", "comments"), _JSON_OPTIONS)
    return F.concat(F.lit("["), F.col("post_id"), F.lit(", "), body, F.lit("]"))


def _shard(num_shards: int) -> Column:
    return F.pmod(F.xxhash64("dataset", "post_id"), F.lit(num_shards)).cast("int")


def _write(lines: DataFrame, output_dir: str, mode: str, sites, line_sep: str = "\n") -> None:
    """Write text files by dataset; overwriting replaces whole datasets and no others.

    New files are written beside the old ones, and each dataset changes over in one step.
    ``sites`` are the datasets of this run: one without records loses its old ones.
    """
    if mode != "overwrite":
        lines.write.mode(mode).partitionBy("dataset").option("lineSep", line_sep).text(output_dir)
        return
    root = output_dir.rstrip("/")
    staged = f"{root}/_staged-{uuid.uuid4().hex}"
    lines.write.partitionBy("dataset").option("lineSep", line_sep).text(staged)
    publish(lines.sparkSession, staged, root, list(sites or ()))
    delete_folder(lines.sparkSession, staged)


def _placed(records: DataFrame, num_shards: int | None, spread: int) -> DataFrame:
    """Records dealt over the tasks that write them."""
    if num_shards is None:
        return records.hint("rebalance", "dataset")
    place = F.pmod(F.xxhash64("dataset"), F.lit(spread)).cast("int") * num_shards
    return records.repartitionById(num_shards * spread, place + _shard(num_shards))


def write_jsonl(
    records: DataFrame,
    output_dir: str,
    num_shards: int | None = None,
    mode: str = "errorifexists",
    sites: Sequence[str] | None = None,
    spread: int = 16,
) -> None:
    """One record per line.

    Without ``num_shards`` Spark balances the files: a big dataset is split over
    many tasks and small ones share a task, so that neither one site with most
    of the posts nor many small sites hurt.  With it, every dataset gets that
    many files (fewer where there are fewer records than that), and datasets are
    dealt over ``spread`` times as many tasks.

    ``overwrite`` replaces the datasets in ``records`` and those named in ``sites``.
    """
    lines = _placed(records, num_shards, spread).select("dataset", record_json().alias("value"))
    _write(lines, output_dir, mode, sites)


def json_array_lines(placed: DataFrame) -> DataFrame:
    """``(dataset, value)``: the records of each dataset in a task framed as one JSON array.

    Brackets and commas come from the place of a record in its task, so a file may be of any size
    and a dataset of any number of files; no more than a batch of records is held.
    """
    ordered = placed.sortWithinPartitions("dataset", "post_id").select("dataset", record_json().alias("value"))

    def frame(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held, place = None, None, 0  # the record held back may still need a comma
        for batch in batches:
            out = []
            for dataset, value in zip(batch.column("dataset").to_pylist(), batch.column("value").to_pylist()):
                if held is not None:
                    out.append((current, held + ("," if dataset == current else "\n]")))
                held = value if held is not None and dataset == current else f"[\n{value}"
                current = dataset
            yield numbered(out, place)
            place += len(out)
        if held is not None:
            yield numbered([(current, held + "\n]")], place)

    def numbered(rows: list[tuple[str, str]], place: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [
                pa.array([r[0] for r in rows], pa.string()),
                pa.array([r[1] for r in rows], pa.string()),
                pa.array(range(place, place + len(rows)), pa.int64()),
            ],
            ["dataset", "value", "place"],
        )

    framed = ordered.mapInArrow(frame, "dataset STRING, value STRING, place BIGINT")
    # The writer would sort by dataset alone, and not say how it leaves the order within one.
    return framed.sortWithinPartitions("dataset", "place").select("dataset", "value")


def write_json_array(
    records: DataFrame,
    output_dir: str,
    num_shards: int | None = None,
    mode: str = "errorifexists",
    sites: Sequence[str] | None = None,
    spread: int = 16,
) -> None:
    """Valid JSON files, each one array, placed and overwritten as in ``write_jsonl``."""
    _write(json_array_lines(_placed(records, num_shards, spread)), output_dir, mode, sites)


def record_fragments(rows: DataFrame) -> DataFrame:
    """``(dataset, value)``: the JSON text of records piece by piece, from their long form.

    Pieces stand in order, those of a record in one task; written with a blank behind each they are
    JSON lines.  A record is sorted and written as rows and never one value, so it may be of any size.
    """
    # Of a post's own row come the pieces around its texts.
    frames = F.expr("CASE part WHEN 'post' THEN array(0, 2, 4) WHEN 'text_block' THEN array(1) ELSE array(3) END")
    columns = ["dataset", "post_id", "score", "position", "text"]
    pieces = rows.select(*columns, F.explode(frames).alias("step"))
    in_order = Window.partitionBy("dataset", "post_id").orderBy(
        "step", F.col("position").isNull(), "position", "text"
    )
    listed = F.to_json(F.array("text"), _JSON_OPTIONS)
    text = F.substr(listed, F.lit(2), F.length(listed) - 2)
    comma = F.when(F.lag("step").over(in_order) == F.col("step"), F.lit(",")).otherwise(F.lit(""))
    value = (
        F.when(F.col("step") == 0, F.concat(F.lit("["), "post_id", F.lit(', {"score":'), "score", F.lit(',"text_blocks":[')))
        .when(F.col("step") == 2, F.lit('],"comments":['))
        .when(F.col("step") == 4, F.lit("]}]\n"))
        .otherwise(F.concat(comma, text))
    )
    return pieces.select("dataset", value.alias("value"))


def write_streamed(
    rows: DataFrame, output_dir: str, mode: str = "errorifexists", sites: Sequence[str] | None = None
) -> None:
    """JSON lines from records in long form (``record_rows``), for records of any size.

    A record begins with a blank, and a file may end with one more line of a blank.  Overwriting is
    as in ``write_jsonl``.
    """
    _write(record_fragments(rows), output_dir, mode, sites, line_sep=" ")
