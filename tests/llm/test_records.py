import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from postsieve.llm import records
from postsieve.llm.common import scratch_dir
from .conftest import AWKWARD

PATH = public_tokenizers.path("byte_bpe_50k.json")


def crc32c(data):
    crc = 0xFFFFFFFF
    for byte in data:
        crc ^= byte
        for _ in range(8):
            crc = (crc >> 1) ^ (0x82F63B78 if crc & 1 else 0)
    crc ^= 0xFFFFFFFF
    return ((crc >> 15 | crc << 17) + 0xA282EAD8) & 0xFFFFFFFF


def test_checksums_equal_the_bitwise_rule():
    rng = np.random.default_rng(0)
    payloads = [rng.bytes(n) for n in (4, 8, 255, 256, 257, 700, 3000, 5)]
    assert records.masked_crc32c(payloads).tolist() == [crc32c(p) for p in payloads]
    assert crc32c(b"123456789") == ((0xE3069283 >> 15 | 0xE3069283 << 17) + 0xA282EAD8) & 0xFFFFFFFF
    assert len(records.masked_crc32c([])) == 0


def expected(rows):
    tokenizer, start, out = Tokenizer.from_file(PATH), 0, []
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    for doc_id, text in order:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        out.append((doc_id, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), ids))
    return out


def test_round_trip_of_awkward_rows(spark, awkward):
    folder = scratch_dir(spark)
    files = records.write_sequences(awkward, folder, PATH)
    found = records.read_sequences(spark, folder, files).orderBy("part", "record").collect()
    wanted = expected([(doc_id, text) for doc_id, text, _ in AWKWARD])
    key = lambda x: (x[0] is not None, x[0] or 0, x[2])
    rows = [(r.doc_id, r.n_tokens, r.ids_crc32, list(r.ids)) for r in found]
    assert sorted(rows, key=key) == sorted(wanted, key=key)
    assert [r[0] for r in rows] == [r[0] for r in wanted]  # ascending
    starts = np.cumsum([r.n_tokens for r in found]) - [r.n_tokens for r in found]
    assert [r.start for r in found] == starts.tolist()
    summary = files.orderBy("part").collect()
    assert sum(r.n_records for r in summary) == len(AWKWARD)
    # By index alone, in any order.
    last = [r for r in found if r.part == summary[-1].part]
    numbers = [r.record for r in last][::-1]
    for row, (doc_id, ids) in zip(last[::-1], records.read_records(folder, summary[-1].file, numbers)):
        assert doc_id == row.doc_id and ids.tolist() == list(row.ids)


def test_damage_is_found(spark, awkward):
    folder = scratch_dir(spark)
    files = records.write_sequences(awkward, folder, PATH)
    name = folder.removeprefix("file://") + "/" + files.first().file + ".rec"
    with open(name, "r+b") as file:
        file.seek(30)
        byte = file.read(1)[0]
        file.seek(30)
        file.write(bytes([byte ^ 1]))
    with pytest.raises(Exception, match="checksum"):
        records.read_sequences(spark, folder, files).collect()


def test_empty_table_writes_nothing(spark, empty):
    folder = scratch_dir(spark)
    files = records.write_sequences(empty, folder, PATH)
    assert files.count() == 0
    assert records.read_sequences(spark, folder, files).count() == 0


def test_query_over_the_documents(spark, sf_dir):
    from postsieve.llm.queries import op1_token_records

    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    found = op1_token_records(spark, sf_dir).orderBy("doc_id")
    rows = [(r.doc_id, r.n_tokens, r.ids_crc32) for r in found.collect()]
    assert rows == [r[:3] for r in expected(docs)]
    assert found.agg(F.max(F.col("start") + F.col("n_tokens"))).first()[0] == sum(r[1] for r in rows)
