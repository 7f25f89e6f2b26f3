"""One query per operator over the test tables; scalar result columns only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postsieve.functions.columns import dataset_slug, has_letter_or_digit
from postsieve.operators import assemble, blocks, comments, folds, history, lines, posts, reports
from postsieve.plans import corpus as plans
from postsieve.sinks import json_files, versions
from postsieve.sources import dumps, faults
from postsieve.suite import views

KEYS = ["dataset", "post_id"]
#: Joins list entries where a query shows a list as one value.
LIST_MARK = "\n~\n"
NUM_SHARDS = 4

Query = Callable[[SparkSession, str], DataFrame]


def _number(col: Column | str) -> Column:
    return F.col(col).cast("bigint") if isinstance(col, str) else col.cast("bigint")


def _flag(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(False)).cast("bigint").alias(name)


def _toggle(name: str) -> Column:
    col = F.col(name)
    return F.when(col, "open").when(~col, "close").otherwise("keep").alias(name)


def _score_or_none() -> Column:
    """A nullable score as text, so that both engines print it alike."""
    return F.coalesce(F.col("score").cast("string"), F.lit("(none)")).alias("score")


def _listed(name: str) -> list[Column]:
    return [
        _number(F.size(name)).alias(f"n_{name}"),
        F.array_join(name, LIST_MARK).alias(name),
    ]


# --- scans -----------------------------------------------------------------------


def _scan(name: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        root = views.write_dump(spark, sf_dir, [name])
        return dumps.read_lines(spark, root, views.DATASETS, name)

    return query


def dataset_from_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = views.write_dump(spark, sf_dir)
    counts = [
        dumps.read_lines(spark, root, None, name)
        .groupBy("dataset")
        .agg(F.count("*").alias("n_lines"))
        .select("dataset", F.lit(name).alias("table_name"), "n_lines")
        for name in dumps.TABLE_FILES
    ]
    return counts[0].union(counts[1]).union(counts[2])


def multi_dataset_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = views.write_dump(spark, sf_dir)
    rows = [
        dumps.read_table(spark, root, views.DATASETS, name).select("dataset", F.lit(name).alias("t"))
        for name in dumps.TABLE_FILES
    ]
    counts = [F.count_if(F.col("t") == name).alias(f"n_{name}") for name in dumps.TABLE_FILES]
    return rows[0].union(rows[1]).union(rows[2]).groupBy("dataset").agg(*counts)


def _raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = [
        views.with_root_tags(spark, views.xml_lines(raw(spark, sf_dir)), name)
        for name, raw in views.RAW_TABLES.items()
    ]
    return tables[0].union(tables[1]).union(tables[2])


def filter_row_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dumps.row_lines(_raw_lines(spark, sf_dir))


def parse_row_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _attributes(dumps.row_lines(_raw_lines(spark, sf_dir)))


def _attributes(rows: DataFrame) -> DataFrame:
    names = ("Id", "PostId", "PostHistoryTypeId", "CreationDate", "Score", "Text")
    return dumps.row_attributes(rows, names).select(
        "dataset", *(F.coalesce(F.col(name), F.lit("(absent)")).alias(name) for name in names)
    )


def rows_over_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of a dump with an attribute to a line, as ``parse_row_attributes`` has them."""
    root = views.write_dump(spark, sf_dir, pretty=True)
    found = [dumps.read_rows(spark, root, None, name, "element") for name in dumps.TABLE_FILES]
    return _attributes(found[0].union(found[1]).union(found[2]))


def corpus_from_pretty_dump(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records of such a dump."""
    root = views.write_dump(spark, sf_dir, pretty=True)
    return _listed_records(plans.corpus(spark, root, layout="element"))


#: The site whose rows are damaged, and one of which a file is missing.
DAMAGED, INCOMPLETE = views.DATASETS[1], "d.example.com"


def _damaged_dump(spark: SparkSession, sf_dir: str) -> str:
    """A dump with faults in one site, and a further site with one file only."""
    root = views.write_dump(spark, sf_dir, damaged=DAMAGED)
    views.copy_posts(spark, root, views.DATASETS[0], INCOMPLETE)
    return root


def site_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = faults.site_faults(spark, _damaged_dump(spark, sf_dir))
    return found.withColumn("n_rows", F.coalesce("n_rows", F.lit(-1)))


def sound_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of the sites that a run over a partly damaged dump has written."""
    out = views.scratch_dir(spark) + "/corpus"
    plans.run_sound_sites(spark, _damaged_dump(spark, sf_dir), out)
    return _from_json_lines(versions.read_json_text(spark, out))


def cast_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and scores of all tables, written with signs and blanks; absent ones are -1."""
    names = ("Id", "PostId", "PostHistoryTypeId", "Score")
    found = []
    for table, raw in views.RAW_TABLES.items():
        printed = views.xml_lines(views.with_blanks_and_signs(raw(spark, sf_dir)))
        parsed = dumps.row_attributes(dumps.row_lines(printed), names)
        values = [F.coalesce(_number(n), F.lit(-1)).alias(n) for n in names]
        found.append(parsed.select("dataset", F.lit(table).alias("table_name"), *values))
    return found[0].union(found[1]).union(found[2])


def dataset_slugs(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.concat(F.initcap("source"), F.lit(". "), F.upper("lang"), F.lit("_-site"))
    return (
        views.table(spark, sf_dir, "documents")
        .groupBy(name.alias("dataset"))
        .agg(F.count("*").alias("n_rows"))
        .select("dataset", dataset_slug(F.col("dataset"), "corpus-job").alias("slug"), "n_rows")
    )


# --- posts, comments, history ----------------------------------------------------


def filter_post_edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.post_edits(views.raw_history(spark, sf_dir)).select(
        "dataset", "Id", "PostId", _number("PostHistoryTypeId").alias("PostHistoryTypeId")
    )


def filter_comment_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.comments(spark, sf_dir).select(*KEYS, "comment_id", "score")


def project_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.posts(spark, sf_dir)


def project_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.comments(spark, sf_dir)


def project_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.project_history(views.raw_history(spark, sf_dir))


def comments_per_post(spark: SparkSession, sf_dir: str) -> DataFrame:
    grouped = comments.comments_per_post(views.comments(spark, sf_dir))
    return grouped.select(*KEYS, *_listed("comments"))


def _posts_with_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return posts.project_posts(views.raw_posts_with_repeats(spark, sf_dir))


def _scores_with_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return posts.single_score_per_post(_posts_with_repeats(spark, sf_dir))


def single_score_per_post(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scores_with_repeats(spark, sf_dir).select(*KEYS, _score_or_none())


def filter_positive_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return posts.positive_score(_scores_with_repeats(spark, sf_dir))


def duplicate_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return posts.duplicate_posts(_posts_with_repeats(spark, sf_dir))


def assert_unique_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.unique_score_violations(_posts_with_repeats(spark, sf_dir))


def required_attribute_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each table's mandatory attributes in rows of which some lack them or have bad numbers."""
    found = []
    for table, kinds in dumps.REQUIRED_ATTRIBUTES.items():
        faulty = views.with_faults(views.RAW_TABLES[table](spark, sf_dir))
        rows = dumps.row_attributes(dumps.row_lines(views.xml_lines(faulty)), kinds)
        report = reports.required_attribute_report(rows, kinds)
        found.append(report.select(F.lit(table).alias("table_name"), "*"))
    return found[0].union(found[1]).union(found[2])


def latest_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.latest_version(views.edits(spark, sf_dir))


def latest_version_by_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.latest_version_by_max(views.edits(spark, sf_dir))


# --- text blocks -----------------------------------------------------------------


def _split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.split_lines(views.markdown(spark, sf_dir), ["doc_id"], "Text")


def split_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _split(spark, sf_dir).select("doc_id", _number("pos").alias("pos"), "raw")


def line_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    flags = ("is_space", "is_indented", "is_language", "is_divider", "is_inline", "has_alnum")
    return (
        lines.line_flags(_split(spark, sf_dir))
        .withColumn("has_alnum", has_letter_or_digit(F.col("raw")))
        .select("doc_id", _number("pos").alias("pos"), *map(_flag, flags))
    )


def tag_strip(spark: SparkSession, sf_dir: str) -> DataFrame:
    toggles = ("set_snippet", "set_code", "set_script", "set_fence")
    return lines.strip_markers(lines.line_flags(_split(spark, sf_dir))).select(
        "doc_id",
        _number("pos").alias("pos"),
        F.coalesce("line", F.lit("(used up)")).alias("line"),
        *map(_toggle, toggles),
        _flag("close_code_after"),
    )


def _traced(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blocks.traced_lines(views.markdown(spark, sf_dir), ["doc_id"], "Text")


def noncode_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = _traced(spark, sf_dir).where("is_kept")
    return kept.select("doc_id", _number("pos").alias("pos"), _flag("in_code"), _flag("after_symbols"))


def line_block_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = _traced(spark, sf_dir).where("is_kept")
    state = F.coalesce("state", F.lit("none")).alias("state")
    return kept.select("doc_id", _number("pos").alias("pos"), state, _number("block_no").alias("block_no"))


def _contents(spark: SparkSession, sf_dir: str) -> DataFrame:
    contents = blocks.block_contents(_traced(spark, sf_dir), ["doc_id"])
    return contents.where(F.col("block_type").isNotNull()).select(
        "doc_id", _number("block_no").alias("block_no"), "block_type", "content"
    )


def block_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _contents(spark, sf_dir)


def nonblank_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blocks.nonblank_blocks(_contents(spark, sf_dir))


def blocks_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        blocks.nonblank_blocks(_contents(spark, sf_dir))
        .groupBy("block_type")
        .agg(
            F.count("*").alias("n_blocks"),
            F.count_distinct("doc_id").alias("n_docs"),
            F.sum(F.length("content")).alias("n_chars"),
        )
    )


def revise_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    revised = blocks.markdown_blocks(views.markdown(spark, sf_dir), ["doc_id"], "Text")
    block = F.posexplode("blocks").alias("ord", "block")
    return revised.select("doc_id", block).select(
        "doc_id", _number("ord").alias("ord"), "block.block_type", "block.content"
    )


def _prose(texts: DataFrame, text_col: str) -> DataFrame:
    found = blocks.text_blocks(texts, ["doc_id"], text_col)
    return found.select("doc_id", *_listed("text_blocks"))


def text_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _prose(views.markdown(spark, sf_dir), "Text")


def text_blocks_by_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same text blocks without a shuffle."""
    found = folds.text_blocks_by_fold(views.markdown(spark, sf_dir), ["doc_id"], "Text")
    return found.select("doc_id", *_listed("text_blocks"))


def text_blocks_closed_fences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text blocks where a lone fence closes an open one."""
    found = blocks.text_blocks(views.markdown(spark, sf_dir), ["doc_id"], "Text", close_fences=True)
    return found.select("doc_id", *_listed("text_blocks"))


def blocks_without_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All blocks less those that went into a neighbour."""
    found = blocks.markdown_blocks(views.markdown(spark, sf_dir), ["doc_id"], "Text", drop_merged=True)
    return found.select("doc_id", F.posexplode("blocks").alias("ord", "block")).select(
        "doc_id", _number("ord").alias("ord"), "block.block_type", "block.content"
    )


def document_text_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _prose(views.table(spark, sf_dir, "documents"), "text")


# --- records ---------------------------------------------------------------------


def _cogrouped(spark: SparkSession, sf_dir: str) -> DataFrame:
    newest = history.latest_version(views.edits(spark, sf_dir))
    return assemble.cogroup(
        _scores_with_repeats(spark, sf_dir),
        blocks.text_blocks(newest, KEYS),
        comments.comments_per_post(views.comments(spark, sf_dir)),
    )


def cogroup_full_outer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cogrouped(spark, sf_dir).select(
        *KEYS, _score_or_none(), *_listed("text_blocks"), *_listed("comments")
    )


def flatten_and_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All entries of all lists; an empty list, present or not, is one row with ``ord`` -1."""
    items = assemble.record_items(_cogrouped(spark, sf_dir))
    place = F.coalesce(_number("ord"), F.lit(-1)).alias("ord")
    return items.select(*KEYS, "part", place, F.coalesce("text", F.lit("(none)")).alias("text"))


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assemble.post_records(
        views.posts(spark, sf_dir), views.comments(spark, sf_dir), views.edits(spark, sf_dir)
    )


def _listed_records(records: DataFrame) -> DataFrame:
    return records.select(*KEYS, "score", *_listed("text_blocks"), *_listed("comments"))


def posts_with_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _listed_records(_records(spark, sf_dir))


def records_long_form(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records as rows; a post's own row has position -1."""
    rows = assemble.record_rows(
        views.posts(spark, sf_dir), views.comments(spark, sf_dir), views.edits(spark, sf_dir)
    )
    place = F.coalesce("position", F.lit(-1)).alias("position")
    return rows.select(*KEYS, "score", "part", place, F.coalesce("text", F.lit("(none)")).alias("text"))


def orphan_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assemble.orphan_keys(
        views.posts(spark, sf_dir),
        views.comments(spark, sf_dir),
        views.edits(spark, sf_dir),
    )


# --- sinks -----------------------------------------------------------------------


def _from_json_lines(written: DataFrame) -> DataFrame:
    """Parse written record lines back to the columns of ``posts_with_text``."""

    def field(path: str) -> Column:
        return F.get_json_object("value", path)

    def texts(path: str) -> Column:
        return F.from_json(field(path), "array<string>")

    return written.select(
        "dataset",
        field("$[0]").cast("bigint").alias("post_id"),
        field("$[1].score").cast("bigint").alias("score"),
        texts("$[1].text_blocks").alias("text_blocks"),
        texts("$[1].comments").alias("comments"),
    ).select(*KEYS, "score", *_listed("text_blocks"), *_listed("comments"))


def _read_output(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("lineSep", "\n").text(path)


def sink_jsonl_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = views.scratch_dir(spark) + "/corpus"
    json_files.write_jsonl(_records(spark, sf_dir), out)
    return _from_json_lines(_read_output(spark, out))


def sink_json_array_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = views.scratch_dir(spark) + "/corpus"
    json_files.write_json_array(_records(spark, sf_dir), out, NUM_SHARDS)
    return _from_json_lines(_array_entries(spark, out))


def _array_entries(spark: SparkSession, out: str) -> DataFrame:
    """The records in files of one JSON array each, one to a line."""
    return (
        _read_output(spark, out)
        .where(~F.col("value").isin("[", "]"))
        .select("dataset", F.regexp_replace("value", r",\z", "").alias("value"))
    )


def sink_balanced_array_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON arrays in as many files as Spark thinks fit."""
    out = views.scratch_dir(spark) + "/corpus"
    json_files.write_json_array(_records(spark, sf_dir), out)
    return _from_json_lines(_array_entries(spark, out))


def sink_streamed_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records written piece by piece, read back as JSON lines."""
    out = views.scratch_dir(spark) + "/corpus"
    tables = (views.posts(spark, sf_dir), views.comments(spark, sf_dir), views.edits(spark, sf_dir))
    json_files.write_streamed(assemble.record_rows(*tables), out)
    return _from_json_lines(versions.read_json_text(spark, out))


def sink_replaced_site(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All sites, of which one was written again with every other post only."""
    out = views.scratch_dir(spark) + "/corpus"
    records = _records(spark, sf_dir)
    json_files.write_jsonl(records, out)
    again = records.where((F.col("dataset") == views.DATASETS[2]) & (F.col("post_id") % 2 == 0))
    json_files.write_jsonl(again, out, mode="overwrite", sites=[views.DATASETS[2]])
    return _from_json_lines(versions.read_json_text(spark, out))


def sink_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = views.scratch_dir(spark) + "/corpus"
    json_files.write_jsonl(_records(spark, sf_dir), out, NUM_SHARDS)
    return (
        _read_output(spark, out)
        .select("dataset", F.col("_metadata.file_path").alias("path"))
        .groupBy("dataset")
        .agg(F.count_distinct("path").alias("n_files"), F.count("*").alias("n_records"))
    )


def corpus_from_dump(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Everything end to end: dump files in, JSON lines out, read back."""
    root = views.write_dump(spark, sf_dir)
    out = views.scratch_dir(spark) + "/corpus"
    plans.run(spark, root, out, views.DATASETS)
    return _from_json_lines(_read_output(spark, out))


QUERIES: dict[str, Query] = {
    "scan_posts_xml": _scan("posts"),
    "scan_comments_xml": _scan("comments"),
    "scan_history_xml": _scan("post_history"),
    "dataset_from_path": dataset_from_path,
    "multi_dataset_counts": multi_dataset_counts,
    "sink_jsonl_roundtrip": sink_jsonl_roundtrip,
    "sink_json_array_roundtrip": sink_json_array_roundtrip,
    "sink_shards": sink_shards,
    "sink_balanced_array_roundtrip": sink_balanced_array_roundtrip,
    "sink_streamed_roundtrip": sink_streamed_roundtrip,
    "sink_replaced_site": sink_replaced_site,
    "rows_over_lines": rows_over_lines,
    "corpus_from_pretty_dump": corpus_from_pretty_dump,
    "site_faults": site_faults,
    "sound_sites": sound_sites,
    "text_blocks_by_fold": text_blocks_by_fold,
    "text_blocks_closed_fences": text_blocks_closed_fences,
    "blocks_without_merged": blocks_without_merged,
    "filter_row_lines": filter_row_lines,
    "filter_post_edits": filter_post_edits,
    "filter_comment_score": filter_comment_score,
    "filter_positive_posts": filter_positive_posts,
    "parse_row_attributes": parse_row_attributes,
    "project_posts": project_posts,
    "project_comments": project_comments,
    "project_history": project_history,
    "cast_ids": cast_ids,
    "dataset_slug": dataset_slugs,
    "comments_per_post": comments_per_post,
    "single_score_per_post": single_score_per_post,
    "duplicate_posts": duplicate_posts,
    "latest_version": latest_version,
    "latest_version_by_max": latest_version_by_max,
    "cogroup_full_outer": cogroup_full_outer,
    "posts_with_text": posts_with_text,
    "records_long_form": records_long_form,
    "orphan_keys": orphan_keys,
    "flatten_and_default": flatten_and_default,
    "assert_unique_scores": assert_unique_scores,
    "required_attribute_report": required_attribute_report,
    "split_lines": split_lines,
    "line_flags": line_flags,
    "tag_strip": tag_strip,
    "noncode_flags": noncode_flags,
    "line_block_state": line_block_state,
    "text_blocks": text_blocks,
    "document_text_blocks": document_text_blocks,
    "block_content": block_content,
    "nonblank_blocks": nonblank_blocks,
    "blocks_by_type": blocks_by_type,
    "revise_blocks": revise_blocks,
    "corpus_from_dump": corpus_from_dump,
}
