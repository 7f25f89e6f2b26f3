import importlib
import sys
from collections import Counter

import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from postsieve.llm import line_dedup, quality
from postsieve.llm.common import stored
from postsieve.llm.queries import table

from .test_near_join import plain_components


def test_stages_of_the_documents(spark, sf_dir):
    """Each stage on what the stage before kept, against its operator's own plain rules."""
    docs = table(spark, sf_dir, "documents")
    names = docs.columns
    results = []
    for _, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, sf_dir))
        results.append(docs)
    good, lines, distinct, mixed, packed = results
    assert all(df.columns == names for df in results[:4])

    source = table(spark, sf_dir, "documents")
    field = quality.train_field(source, table(spark, sf_dir, "labels"))
    kept = {r.doc_id for r in quality.judge(source, field).where("kept").collect()}
    assert {r.doc_id for r in good.collect()} == kept and good.count() == len(kept)

    removed = {r.doc_id: r for r in line_dedup.dedup_lines(good).collect()}
    left = {r.doc_id: r for r in lines.collect()}
    for doc_id, r in removed.items():
        gone = r.removed is not None and not r.text.strip()
        assert (doc_id not in left) == gone
        if not gone:
            assert left[doc_id].text == r.text and left[doc_id].n_chars == len(r.text)

    rows = [(r.doc_id, r.text) for r in left.values()]
    smallest = plain_components(rows, 5, (80, 100))
    expected = {d for d, _, component in smallest if d == component}
    assert {r.doc_id for r in distinct.collect()} == expected

    texts = {r.doc_id: r.text for r in distinct.collect()}
    copies = Counter()
    for r in mixed.collect():
        assert texts[r.doc_id] == r.text
        copies[r.doc_id] += 1

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    sizes = {d: len(tokenizer.encode(texts[d], add_special_tokens=False).ids) + 1 for d in copies}
    found = packed.collect()
    assert Counter(r.doc_id for r in found if r.piece == 0) == copies
    assert sum(r.length for r in found) == sum(sizes[d] * n for d, n in copies.items())
    fill = packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).agg(F.max("n"), F.count("*")).first()
    assert fill[0] <= 4096 and fill[1] <= sum(r.length for r in found) / 4096 * 1.1 + 1


def test_registered_query_gives_the_same_rows(spark, sf_dir):
    import __spark_entry__

    assert __spark_entry__.queries()["pipeline"] is corpus_pipeline.run
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
    for n in range(1, 14):
        assert sum(name.startswith(f"op{n}_") for name in __spark_entry__.queries()) == 1


def test_entry_works_without_the_subpackage(monkeypatch):
    monkeypatch.setitem(sys.modules, "corpus_pipeline", None)
    monkeypatch.setitem(sys.modules, "postsieve.llm", None)
    import __spark_entry__

    try:
        names = importlib.reload(__spark_entry__).queries()
        assert "posts_with_text" in names and not any(n.startswith("op") for n in names)
        assert "pipeline" not in names
    finally:
        monkeypatch.undo()
        importlib.reload(__spark_entry__)



def test_stages_on_awkward_rows(spark, sf_dir):
    """NULLs, repeats and columns with the operators' own names: each stage returns its input's columns."""
    names = ["removed", "n_lines", "kept", "mix_count", "mix_copy", "rate", "row_key", "group", "k1", "labels"]
    prose = " ".join(f"word{i} and more" for i in range(40))
    rows = [
        (1, prose, "en", "a", 10), (1, prose, "en", "a", 10), (1, prose + " end", "en", None, 10),
        (2, prose.replace("word7 ", "other "), "de", "b", 10), (None, prose, None, "b", 10),
        (None, None, None, None, None), (3, "", "en", "a", 0), (4, " \n ", "en", "a", 3), (5, "short", "en", "a", 5),
    ]
    schema = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"
    docs = spark.createDataFrame(rows, schema).select("*", *[F.concat(F.lit(f"{n} "), F.coalesce("lang", F.lit("-"))).alias(n) for n in names])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stored(stage(spark, docs, sf_dir))
        assert out.columns == docs.columns and dict(out.dtypes) == dict(docs.dtypes), name
        for row in out.collect():
            assert all(row[n] == f"{n} {row.lang or '-'}" for n in names), name
        empty = stage(spark, docs.where("false"), sf_dir)
        assert empty.columns == docs.columns and empty.count() == 0
    distinct = corpus_pipeline.one_of_each_group(spark, docs, sf_dir).collect()
    assert sorted((r.doc_id or 0) for r in distinct if r.text and len(r.text) > 50) == [1]
