"""Dump files in, JSON files out."""

import json
import pathlib

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from postsieve.functions.columns import dataset_slug
from postsieve.plans.corpus import corpus, run, run_sound_sites
from postsieve.sinks import json_files, versions
from postsieve.sinks.json_files import write_json_array, write_jsonl, write_streamed
from postsieve.sources.dumps import read_elements, read_lines, read_table, row_attributes, row_lines
from postsieve.sources.faults import site_faults

HEAD = '<?xml version="1.0" encoding="utf-8"?>\n'


def write(path, root, lines, newline="\n"):
    path.parent.mkdir(parents=True, exist_ok=True)
    body = newline.join([f"<{root}>", *lines, f"</{root}>"])
    path.write_text(HEAD + body, encoding="utf-8", newline="")


@pytest.fixture(scope="module")
def dump(tmp_path_factory):
    root = tmp_path_factory.mktemp("dump")
    site = root / "a.example.com"
    write(
        site / "Posts.xml",
        "posts",
        [
            '  <row Id="1" Score="3" Body="ignored &lt;p&gt;" />',
            '\t<row Id="2" Score="-1" />',
            '  <row Id="3" Score="8" />',
        ],
    )
    write(
        site / "Comments.xml",
        "comments",
        [
            '  <row Id="2" PostId="1" Score="1" Text="later, ’quoted’" />',
            '  <row Id="1" PostId="1" Score="5" Text=" padded &amp; kept " />',
            '  <row Id="3" PostId="1" Score="0" Text="no" />',
        ],
        newline="\r\n",
    )
    write(
        site / "PostHistory.xml",
        "posthistory",
        [
            '  <row Id="1" PostHistoryTypeId="2" PostId="1" CreationDate="2020-01-01" Text="old" />',
            '  <row Id="2" PostHistoryTypeId="5" PostId="1" CreationDate="2020-01-02" '
            'Text="new é&#xD;&#xA;&#xD;&#xA;    code&#xD;&#xA;&#xD;&#xA;more" />',
            '  <row Id="3" PostHistoryTypeId="2" PostId="3" CreationDate="2020-01-01" />',
            '  <row Id="4" PostHistoryTypeId="1" PostId="3" CreationDate="2020-01-03" Text="title" />',
        ],
    )
    other = root / "b c+d.example.com"
    write(other / "Posts.xml", "posts", ['<row Id="1" Score="1"/>'])
    write(other / "Comments.xml", "comments", [])
    write(other / "PostHistory.xml", "posthistory", [])
    return root


RECORDS = {
    "a.example.com": [
        [
            1,
            {
                "score": 3,
                "text_blocks": ["new é", "more"],
                "comments": [" padded & kept ", "later, ’quoted’"],
            },
        ],
        [3, {"score": 8, "text_blocks": [], "comments": []}],
    ],
    "b c+d.example.com": [[1, {"score": 1, "text_blocks": [], "comments": []}]],
}


def test_lines_of_all_datasets(spark, dump):
    lines = read_lines(spark, str(dump), None, "posts")
    counts = {r.dataset: r["count"] for r in lines.groupBy("dataset").count().collect()}
    assert counts == {"a.example.com": 6, "b c+d.example.com": 4}
    assert row_lines(lines).count() == 4


def test_only_named_datasets_are_read(spark, dump):
    lines = read_lines(spark, str(dump), ["a.example.com"], "comments")
    assert {r.dataset for r in lines.collect()} == {"a.example.com"}


def test_missing_table_file_is_an_error(spark, dump):
    with pytest.raises(PySparkException):
        read_lines(spark, str(dump), ["nowhere.example.com"], "posts").collect()


@pytest.mark.parametrize("names", [None, ["s1.example.com", "s2.example.com"]])
def test_site_without_one_of_its_files_is_an_error(spark, dump, tmp_path, names):
    for site in ("s1.example.com", "s2.example.com"):
        for name in ("Posts.xml", "Comments.xml", "PostHistory.xml"):
            if (site, name) != ("s2.example.com", "PostHistory.xml"):
                write(tmp_path / site / name, "x", ['<row Id="1" Score="1" />'] if name == "Posts.xml" else [])
    with pytest.raises(PySparkException, match="PATH_NOT_FOUND"):
        run(spark, str(tmp_path), str(tmp_path / "out"), names)


def test_run_counts_ambiguous_posts(spark, tmp_path):
    site = tmp_path / "in" / "s.example.com"
    twice = ['<row Id="1" Score="1" />', '<row Id="1" Score="2" />', '<row Id="2" Score="2" />']
    write(site / "Posts.xml", "posts", twice)
    write(site / "Comments.xml", "comments", [])
    write(site / "PostHistory.xml", "posthistory", [])
    assert run(spark, str(tmp_path / "in"), str(tmp_path / "out")) == 1


def test_tables_in_folders_of_part_files(spark, tmp_path):
    for part in ("part-0", "part-1"):
        write(tmp_path / "s.example.com" / "Posts.xml" / part, "posts", ['<row Id="1" Score="1" />'])
    posts = read_table(spark, str(tmp_path), ["s.example.com"], "posts")
    assert [r.dataset for r in posts.collect()] == ["s.example.com"] * 2


ATTRIBUTES = [
    ('  <row A="  a&#xA;b&#xD;&#xA;c\td &lt;x&gt; ’ " />', "  a\nb\r\nc d <x> ’ "),
    ('<row A="" />', ""),
    ("<row />", None),
    ("<row B='1' A='say &quot;hi&quot; &amp;amp;'></row>", 'say "hi" &amp;'),
]


def test_attribute_values_are_kept_as_they_are(spark):
    lines = spark.createDataFrame([(line,) for line, _ in ATTRIBUTES], "value string")
    assert [r.A for r in row_attributes(lines, ["A"]).collect()] == [v for _, v in ATTRIBUTES]


def test_malformed_rows_fail_the_job(spark):
    # The XML parser's own error comes through here, not one of PySpark's.
    lines = spark.createDataFrame([('  <row A="1"',)], "value string")
    with pytest.raises(Exception, match="Unexpected end of input"):
        row_attributes(lines, ["A"]).collect()


def test_row_parser_runs_once_per_row(spark, dump):
    comments = read_table(spark, str(dump), None, "comments").where("cast(Score as int) > 0")
    plan = comments.select("Text")._jdf.queryExecution().executedPlan().toString()
    assert plan.split("Initial Plan")[0].count("from_xml") == 1


def test_scan_keeps_no_unused_attribute(spark, dump):
    assert read_table(spark, str(dump), None, "posts").columns == ["dataset", "Id", "Score"]


def written(path, parse):
    found = {}
    for folder in sorted(pathlib.Path(path).glob("dataset=*")):
        name = folder.name.removeprefix("dataset=")
        values = []
        for file in sorted(folder.rglob("part-*")):
            values += parse(file.read_text(encoding="ascii"))
        found[name] = sorted(values, key=lambda record: record[0])
    return found


def json_lines(text):
    return [json.loads(line) for line in text.splitlines() if line.strip()]


def test_run_writes_json_lines(spark, dump, tmp_path):
    out = str(tmp_path / "out")
    run(spark, str(dump), out)
    assert written(out, json_lines) == RECORDS


def test_run_writes_json_arrays(spark, dump, tmp_path):
    out = str(tmp_path / "out")
    run(spark, str(dump), out, num_shards=2, json_array=True)
    assert written(out, json.loads) == RECORDS


def test_run_writes_arrays_of_any_number(spark, dump, tmp_path):
    out = str(tmp_path / "out")
    run(spark, str(dump), out, json_array=True)
    assert written(out, json.loads) == RECORDS


def test_run_writes_streamed_records(spark, dump, tmp_path):
    out = str(tmp_path / "out")
    assert run(spark, str(dump), out, streamed=True) == 0
    assert written(out, json_lines) == RECORDS
    with pytest.raises(ValueError):
        run(spark, str(dump), out, streamed=True, json_array=True)


def test_run_lists_ambiguous_posts(spark, tmp_path):
    site = tmp_path / "in" / "s.example.com"
    rows = [f'<row Id="{i}" Score="1" />' for i in (1, 1, 2, 3, 3, 3)]
    write(site / "Posts.xml", "posts", rows)
    write(site / "Comments.xml", "comments", [])
    write(site / "PostHistory.xml", "posthistory", [])
    report = str(tmp_path / "report")
    for streamed in (False, True):
        out = str(tmp_path / f"out-{streamed}")
        assert run(spark, str(tmp_path / "in"), out, streamed=streamed, report_dir=report) == 2
        assert written(out, json_lines) == {"s.example.com": [[2, {"score": 1, "text_blocks": [], "comments": []}]]}
    listed = sorted((r.post_id, r.n_rows) for r in spark.read.json(report).collect())
    assert listed == [(1, 2), (3, 3)]


def test_run_does_not_overwrite_unasked(spark, dump, tmp_path):
    out = str(tmp_path / "out")
    run(spark, str(dump), out, ["b c+d.example.com"])
    with pytest.raises(PySparkException):
        run(spark, str(dump), out)


@pytest.mark.parametrize("json_array", [False, True])
def test_overwriting_one_site_leaves_the_others(spark, dump, tmp_path, json_array):
    out = str(tmp_path / "out")
    parse = json.loads if json_array else json_lines
    run(spark, str(dump), out, num_shards=4, json_array=json_array)
    assert written(out, parse) == RECORDS
    kept = {f: f.stat().st_mtime_ns for f in pathlib.Path(out).rglob("dataset=a*/**/part-*")}
    run(spark, str(dump), out, ["b c+d.example.com"], 2, json_array, mode="overwrite")
    assert written(out, parse) == RECORDS
    assert kept == {f: f.stat().st_mtime_ns for f in pathlib.Path(out).rglob("dataset=a*/**/part-*")}
    run(spark, str(dump), out, None, 1, json_array, mode="overwrite")
    assert written(out, parse) == RECORDS
    for folder in pathlib.Path(out).glob("dataset=*"):
        assert len(list(folder.rglob("part-*"))) == 1


def test_overwriting_a_site_that_became_empty_removes_it(spark, dump, tmp_path):
    out = str(tmp_path / "out")
    run(spark, str(dump), out)
    site = tmp_path / "in" / "b c+d.example.com"
    for name in ("Posts.xml", "Comments.xml", "PostHistory.xml"):
        write(site / name, "x", [])
    run(spark, str(tmp_path / "in"), out, mode="overwrite")
    assert written(out, json_lines) == {"a.example.com": RECORDS["a.example.com"]}


@pytest.fixture(scope="module")
def many(spark):
    site = F.when(F.col("id") % 3 == 0, "big.example.com").otherwise(
        F.concat(F.lit("s"), (F.col("id") % 5).cast("string"))
    )
    return spark.range(3000).select(
        site.alias("dataset"),
        F.col("id").alias("post_id"),
        (F.col("id") + 1).alias("score"),
        F.array(F.lit('a "quoted" \\ text\n☃')).alias("text_blocks"),
        F.array().cast("array<string>").alias("comments"),
    )


def expected_many():
    body = {"text_blocks": ['a "quoted" \\ text\n☃'], "comments": []}
    found = {}
    for i in range(3000):
        name = "big.example.com" if i % 3 == 0 else f"s{i % 5}"
        found.setdefault(name, []).append([i, {"score": i + 1, **body}])
    return found


@pytest.mark.parametrize("num_shards", [1, 5])
def test_shards_of_json_lines(many, tmp_path, num_shards):
    out = tmp_path / "out"
    write_jsonl(many, str(out), num_shards)
    assert written(out, json_lines) == expected_many()
    for folder in out.glob("dataset=*"):
        assert len(list(folder.glob("part-*"))) == num_shards


def test_sites_are_written_by_different_tasks(many, tmp_path):
    out = tmp_path / "out"
    write_jsonl(many, str(out), 1)
    tasks = {f.name.split("-")[1] for f in out.glob("dataset=*/part-*")}
    assert len(tasks) > 1


@pytest.mark.parametrize("num_shards", [1, 5])
def test_every_array_file_is_one_json_value(many, tmp_path, num_shards):
    out = tmp_path / "out"
    write_json_array(many, str(out), num_shards)
    assert written(out, json.loads) == expected_many()
    for folder in out.glob("dataset=*"):
        assert len(list(folder.glob("part-*"))) == num_shards


def test_array_frames_need_no_window(many, tmp_path):
    lines = json_files.json_array_lines(many.hint("rebalance", "dataset"))
    assert "Window" not in lines._jdf.queryExecution().executedPlan().toString()
    write_json_array(many, str(tmp_path / "out"))
    assert written(tmp_path / "out", json.loads) == expected_many()


@pytest.mark.parametrize("batch", [1, 2, 7])
def test_array_frames_over_batches(spark, many, tmp_path, batch):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    try:
        write_json_array(many.where("post_id < 60"), str(tmp_path / "out"), 2)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    expected = {name: [r for r in rows if r[0] < 60] for name, rows in expected_many().items()}
    assert written(tmp_path / "out", json.loads) == expected


def test_balanced_files_hold_everything(many, tmp_path):
    write_jsonl(many, str(tmp_path / "out"))
    assert written(tmp_path / "out", json_lines) == expected_many()


def test_corpus_is_lazy_and_typed(spark, dump):
    schema = corpus(spark, str(dump)).schema
    assert schema.simpleString() == (
        "struct<dataset:string,post_id:bigint,score:bigint,"
        "text_blocks:array<string>,comments:array<string>>"
    )


def test_slug(spark):
    names = spark.createDataFrame([("Meta.Some_Site.com",)], "name string")
    slugs = names.select(dataset_slug(F.col("name")), dataset_slug(F.col("name"), "Job"))
    assert tuple(slugs.first()) == ("metasomesitecom", "Job-metasomesitecom")


# --- rows over several lines -------------------------------------------------------


PRETTY = """<?xml version="1.0" encoding="utf-8"?>
<posts>
  <row
      Id="1"
      Score="3" Body="a / b > c &lt;row Id=&quot;9&quot;/&gt; it's"
  /><row Id='2' Score='-1'></row>
  <rows/>
  <row Id="3"
       Score="8"/></posts>"""


@pytest.mark.parametrize("width", [None, 7, 16])
def test_rows_over_lines_and_splits(spark, tmp_path, width):
    path = tmp_path / "s.example.com" / "Posts.xml"
    path.parent.mkdir()
    path.write_text(PRETTY, encoding="utf-8")
    if width:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(width))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        rows = read_elements(spark, str(tmp_path), None, "posts")
        found = row_attributes(rows, ["Id", "Score", "Body"]).drop("dataset").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    body = "a / b > c <row Id=\"9\"/> it's"
    assert sorted(map(tuple, found)) == [("1", "3", body), ("2", "-1", None), ("3", "8", None)]


def test_long_values_over_lines(spark, tmp_path):
    path = tmp_path / "s.example.com" / "Posts.xml"
    path.parent.mkdir()
    body = "word / 'x' > " * 35_000
    path.write_text(f'<posts>\n<row\n Id="1"\n Body="{body}"\n/>\n</posts>', encoding="utf-8")
    rows = row_attributes(read_elements(spark, str(tmp_path), None, "posts"), ["Id", "Body"]).drop("dataset")
    assert [tuple(r) for r in rows.collect()] == [("1", body)]


def test_an_element_without_end_fails(spark, tmp_path):
    path = tmp_path / "s.example.com" / "Posts.xml"
    path.parent.mkdir()
    path.write_text('<posts>\n<row Id="1" Score="1\n<row Id="2" Score="2"/></posts>', encoding="utf-8")
    with pytest.raises(Exception, match="MALFORMED|Malformed|Unexpected|malformed"):
        read_table(spark, str(tmp_path), None, "posts", layout="element").collect()


def test_either_layout_gives_one_corpus(spark, dump, tmp_path):
    run(spark, str(dump), str(tmp_path / "out"), layout="element")
    assert written(tmp_path / "out", json_lines) == RECORDS
    with pytest.raises(ValueError):
        read_table(spark, str(dump), None, "posts", layout="page")


# --- one site's faults ---------------------------------------------------------------


def test_sound_sites_are_written_and_others_reported(spark, dump, tmp_path):
    root = tmp_path / "in"
    for site in dump.iterdir():
        for file in site.iterdir():
            (root / site.name).mkdir(parents=True, exist_ok=True)
            (root / site.name / file.name).write_bytes(file.read_bytes())
    bad = root / "bad.example.com"
    write(bad / "Posts.xml", "posts", ['<row Id="x" Score="1" />', '<row Id="2" Score="1', '<row Score="1" />'])
    # A comment without a positive score needs nothing else, an event of another kind no date.
    write(bad / "Comments.xml", "comments", ['<row Score="0" Id="y" />', '<row Score="1" PostId="1" />'])
    write(bad / "PostHistory.xml", "posthistory", ['<row PostHistoryTypeId="1" />', '<row PostHistoryTypeId="2" PostId="1" Id="z" />'])
    (root / "empty.example.com").mkdir()
    faults = run_sound_sites(spark, str(root), str(tmp_path / "out"))
    assert written(tmp_path / "out", json_lines) == RECORDS
    assert [tuple(f) for f in faults] == [
        ("bad.example.com", "comments", "missing attribute Text", 1),
        ("bad.example.com", "post_history", "malformed attribute Id", 1),
        ("bad.example.com", "post_history", "missing attribute CreationDate", 1),
        ("bad.example.com", "posts", "malformed attribute Id", 1),
        ("bad.example.com", "posts", "malformed row", 1),
        ("bad.example.com", "posts", "missing attribute Id", 1),
        ("empty.example.com", "comments", "missing file", None),
        ("empty.example.com", "post_history", "missing file", None),
        ("empty.example.com", "posts", "missing file", None),
    ]


def test_sound_dump_has_no_faults(spark, dump):
    assert site_faults(spark, str(dump)).isEmpty()


def test_nothing_is_written_if_all_sites_have_faults(spark, tmp_path):
    (tmp_path / "in" / "empty.example.com").mkdir(parents=True)
    assert len(run_sound_sites(spark, str(tmp_path / "in"), str(tmp_path / "out"))) == 3
    assert not (tmp_path / "out").exists()


# --- replacing sites -------------------------------------------------------------------


def read_back(spark, out):
    found = {}
    for row in versions.read_json_text(spark, str(out)).collect():
        found.setdefault(row.dataset, []).append(json.loads(row.value))
    return {name: sorted(values, key=lambda record: record[0]) for name, values in found.items()}


@pytest.mark.parametrize("before", ["once", "twice"])
@pytest.mark.parametrize("step", ["move_folder", "commit", "delete_folder"])
def test_a_lost_driver_leaves_old_or_new(spark, dump, tmp_path, monkeypatch, before, step):
    out = str(tmp_path / "out")
    site = "b c+d.example.com"
    run(spark, str(dump), out)
    if before == "twice":
        run(spark, str(dump), out, mode="overwrite")
    assert read_back(spark, out) == RECORDS
    changed = tmp_path / "in" / site
    write(changed / "Posts.xml", "posts", ['<row Id="7" Score="9"/>'])
    write(changed / "Comments.xml", "comments", [])
    write(changed / "PostHistory.xml", "posthistory", [])
    new = {**RECORDS, site: [[7, {"score": 9, "text_blocks": [], "comments": []}]]}

    def lost(*args):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        patch.setattr(versions, step, lost)
        with pytest.raises(KeyboardInterrupt):
            run(spark, str(tmp_path / "in"), out, mode="overwrite")
    assert read_back(spark, out) == (new if step == "delete_folder" else RECORDS)
    run(spark, str(tmp_path / "in"), out, mode="overwrite")
    assert read_back(spark, out) == new
    folders = [f.name for f in pathlib.Path(out, "dataset=b c+d.example.com").iterdir() if f.name[0] not in "._"]
    assert len(folders) == 1


def test_reading_an_output_that_is_not_there(spark, tmp_path):
    assert versions.read_json_text(spark, str(tmp_path / "nowhere")).collect() == []


# --- records of any size ------------------------------------------------------------------


def test_a_post_with_most_comments_is_one_streamed_record(spark, tmp_path):
    keys = [F.lit("s").alias("dataset"), F.lit(5).cast("bigint").alias("post_id"), F.lit(3).cast("bigint").alias("score")]
    texts = spark.range(120_000).select(
        *keys, F.lit("comment").alias("part"), F.col("id").alias("position"),
        F.concat(F.lit('text "'), F.col("id").cast("string"), F.lit('"\n é')).alias("text"),
    )
    heads = spark.range(4).select(
        F.lit("s").alias("dataset"), (F.col("id") + 4).alias("post_id"), F.lit(3).cast("bigint").alias("score"),
        F.lit("post").alias("part"), F.lit(None).cast("bigint").alias("position"), F.lit(None).cast("string").alias("text"),
    )
    write_streamed(heads.unionByName(texts), str(tmp_path / "out"))
    found = written(tmp_path / "out", json_lines)["s"]
    assert [r[0] for r in found] == [4, 5, 6, 7]
    comments = found[1][1]["comments"]
    assert len(comments) == 120_000 and comments[77_777] == 'text "77777"\n é'
    assert found[0][1] == {"score": 3, "text_blocks": [], "comments": []}
