"""Near-duplicate join by Jaccard similarity of word n-grams, with adaptive multi-match prefixes.

First the documents that hold each n-gram are counted, over the whole table: classes of documents
with equal sets are dealt into chunks, each chunk sends its sorted, distinct n-grams and their counts as
compressed blocks, and gets the sums back.  An n-gram that one class has alone is in no intersection,
so only the others are kept, with the size of the whole set; a class with fewer of them than its
share asks for has no partner and is done.

All n-grams have one order: by that count, rare ones first.  Two sets of the wanted similarity share
at least l members within their first ``size - needed overlap + l`` ones, for any l.  Each set picks
its own l by estimated cost: a longer prefix is more to look up, but pairs must then share more of it
before they are verified.  A pair is held to the smaller of its two l.

Documents with equal sets are one class and never paired.  Families of near copies are linked
first, in rounds: classes that share one of their members with the smallest hashes are sorted in
an order of that member's own, and neighbours are verified, so that each class meets a few random
ones of its family and the family soon is one component.  What is in one component needs no further
pairs.  The full prefixes are then joined for classes of different components only, which finds
every remaining link.  Where very many classes share a prefix member, pairs are not made: the
classes are dealt into blocks, a task compares the sets of two blocks and returns a spanning
forest of the links it finds.  The result is exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postsieve.llm.common import input_tasks, stored
from postsieve.llm.graph import components
from postsieve.llm.shared_names import COUNTS, read_sums, send_counts, summed
from postsieve.llm.words import distinct, mix, small_batches, windows, word_hashes

#: N-grams of the classes in a chunk, and n-grams that one task counts, about.
CHUNK = 1_000_000
COUNTED = 2_000_000
#: Bytes of text that a task holds before it sends them to their chunks.
FLUSH_BYTES = 8 << 20
#: Bits of an n-gram's hash beyond those that number all n-grams.  What is taken for shared though
#: it is not (one in two to this power) is only kept longer.
SPARE_BITS = 10
#: Cost of verifying one candidate, in members of posting lists read.
VERIFY_COST = 30.0
#: Members with the smallest hashes by which families are found, for each round in turn.
FAMILY_ROUNDS = (4,)
#: Classes to fetch are sent to all executors up to this many (8 bytes each).
BROADCAST_KEYS = 1_000_000
#: Classes that share one prefix member are paired by a join up to this many; more are compared in blocks.
SMALL_GROUP = 16
BLOCK_CLASSES = 256
#: Blocks that a group is dealt into, unless blocks would have more classes than this.
MOST_BLOCKS, LARGEST_BLOCK = 64, 1 << 14
#: Classes that a task compares at a time.
TILE = 256
_FAMILY_SEED = np.uint64(0x5851F42D4C957F2D)


def text_sets(texts: pa.Array, n_words: int) -> Iterator[np.ndarray]:
    """Per text its distinct n-gram hashes, ascending; fewer words are one n-gram, none is none."""
    hashes, _, counts = word_hashes(texts, lower=True)
    grams, per_text = windows(hashes, counts, n_words)
    word, gram = 0, 0
    for n, k in zip(counts.tolist(), per_text.tolist()):
        if k:
            yield distinct(grams[gram : gram + k])
        else:
            whole = np.zeros(min(n, 1), np.uint64)
            for i in range(n):
                whole = mix(whole + hashes[word + i])
            yield whole
        word, gram = word + n, gram + k


def _class_id(tokens: np.ndarray) -> int:
    """One number for the whole set; equal sets have equal ones."""
    total = mix(np.array([np.add.reduce(mix(tokens)) + np.uint64(len(tokens))], np.uint64))
    return int(total.view(np.int64)[0])


def _signed(tokens: np.ndarray) -> np.ndarray:
    return tokens.view(np.int64)


def document_classes(docs: DataFrame, n_words: int) -> DataFrame:
    """``(doc_id, row_key, n, class_id)``: a row per document."""
    columns = ["doc_id", "row_key", "n", "class_id"]

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in small_batches(batch):
                sizes, classes = [], []
                for tokens in text_sets(part.column("text"), n_words):
                    sizes.append(len(tokens))
                    classes.append(_class_id(tokens) if len(tokens) else None)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        part.column("row_key"),
                        pa.array(sizes, pa.int64()),
                        pa.array(classes, pa.int64()),
                    ],
                    columns,
                )

    key = docs.schema["row_key"].dataType.simpleString()
    return docs.mapInArrow(describe, f"doc_id BIGINT, row_key {key}, n BIGINT, class_id BIGINT")


def _packed_classes(texts: DataFrame, n_words: int, chunks: int) -> DataFrame:
    """``(chunk, texts)``: compressed blocks of classes with a text of each, few classes twice."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        options = pa.ipc.IpcWriteOptions(compression="zstd")
        held: dict[int, tuple[list[int], list[str]]] = {}
        seen: set[int] = set()
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for chunk, (ids, own) in held.items():
                rows = pa.record_batch([pa.array(ids, pa.int64()), pa.array(own, pa.large_string())], ["class_id", "text"])
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, rows.schema, options=options) as writer:
                    writer.write_batch(rows)
                blob = pa.array([sink.getvalue().to_pybytes()], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array([chunk], pa.int64()), blob], ["chunk", "texts"])
            held.clear()
            if len(seen) > 100_000:
                seen.clear()  # a class that comes again is removed in its chunk

        for batch in batches:
            for part in small_batches(batch):
                column = part.column("text")
                for text, tokens in zip(column, text_sets(column, n_words)):
                    if not len(tokens):
                        continue
                    class_id = _class_id(tokens)
                    if class_id in seen:
                        continue
                    seen.add(class_id)
                    ids, own = held.setdefault(class_id % chunks, ([], []))
                    ids.append(class_id)
                    own.append(text.as_py())
                    size += len(own[-1]) + 64
                    if size > FLUSH_BYTES:
                        yield from flush()
                        size = 0
        yield from flush()

    return texts.mapInArrow(pack, "chunk BIGINT, texts BINARY")


def _chunk_sets(table: pa.Table, n_words: int) -> tuple[list[int], list[np.ndarray]]:
    """The classes of a chunk and their sets."""
    found: dict[int, np.ndarray] = {}
    for blob in table.column("texts"):
        rows = pa.ipc.open_stream(pa.py_buffer(blob.as_py())).read_all()
        for batch in rows.to_batches():
            for part in small_batches(batch):
                for class_id, tokens in zip(part.column("class_id").to_pylist(), text_sets(part.column("text"), n_words)):
                    found.setdefault(class_id, tokens)
    return list(found), list(found.values())


def choose_matches(counts: np.ndarray, n: int, needed: int) -> int:
    """How many shared prefix members a set of ``n`` asks for.

    ``counts`` are the estimated frequencies of its members in order.  With l matches the lists
    of ``n - needed + l`` members are read, and at most their sum over l candidates come up.
    """
    lists = np.cumsum(np.maximum(counts - 1, 0))
    reads = lists[n - needed :].astype(float)
    if not len(reads):
        return 1
    asked = np.arange(1, len(reads) + 1)
    cost = reads + asked + VERIFY_COST * reads / asked
    return int(np.argmin(cost)) + 1


_CLASSES = (
    "class_id BIGINT, n BIGINT, matches BIGINT, prefix ARRAY<BIGINT>, family ARRAY<BIGINT>, members ARRAY<BIGINT>"
)


def open_classes(texts: DataFrame, n_words: int, n_grams: int, share: tuple[int, int]) -> DataFrame:
    """``(class_id, n, matches, prefix, family, members)``: the classes that may have a partner.

    ``members`` are the n-grams of the set that other classes have too, ``n`` is the size of the whole
    set, ``prefix`` are the members to look partners up by, the rarest first, and ``family`` the members with the
    smallest hashes.  ``n_grams`` is how many there are in all, about.
    """
    at_least, of = share
    chunks, buckets = 1 + n_grams // CHUNK, 1 + n_grams // COUNTED
    shift = np.uint64(max(0, 64 - n_grams.bit_length() - SPARE_BITS))
    packed = _packed_classes(texts, n_words, chunks).groupBy("chunk")

    def send(table: pa.Table) -> pa.Table:
        _, sets = _chunk_sets(table, n_words)
        names, counts = np.unique(np.concatenate(sets) >> shift, return_counts=True)
        return send_counts(table.column("chunk")[0].as_py(), names, counts, 64 - int(shift), buckets)

    def keep(table: pa.Table, reply: pa.Table) -> pa.Table:
        ids, sets = _chunk_sets(table, n_words)
        names = distinct(np.concatenate(sets) >> shift)
        sums = read_sums(reply, len(names))
        out = []
        for class_id, tokens in zip(ids, sets):
            n = len(tokens)
            counts = sums[np.searchsorted(names, tokens >> shift)]
            members, counts = tokens[counts > 1], counts[counts > 1]
            needed = -(-at_least * n // of)
            if len(members) < needed:
                continue
            order = np.lexsort((members, counts))
            matches = choose_matches(counts[order], len(members), needed)
            prefix = members[order[: len(members) - needed + matches]]
            few = members[np.argsort(mix(members ^ _FAMILY_SEED))[: sum(FAMILY_ROUNDS)]]
            out.append((class_id, n, matches, *[_signed(x) for x in (prefix, few, members)]))
        kinds = [*[pa.int64()] * 3, *[pa.list_(pa.int64())] * 3]
        lists = list(zip(*out)) if out else [[]] * 6
        names_ = [x.split()[0] for x in _CLASSES.split(", ")]
        return pa.table([pa.array(list(v), k) for v, k in zip(lists, kinds)], names=names_)

    sums = summed(packed.applyInArrow(send, COUNTS))
    return packed.cogroup(sums.groupBy("chunk")).applyInArrow(keep, _CLASSES)


def class_sets(wanted: DataFrame, classes: DataFrame) -> DataFrame:
    """``(class_id, n, members)`` of the wanted classes."""
    keys = stored(wanted.distinct())
    chosen = F.broadcast(keys) if keys.count() <= BROADCAST_KEYS else keys
    return classes.select("class_id", "n", "members").join(chosen, "class_id", "left_semi")


def linked_pairs(pairs: DataFrame, sets: DataFrame, share: tuple[int, int]) -> DataFrame:
    """Those pairs ``(a, b)`` of classes whose sets reach the similarity.

    Each pair carries the set of ``a`` to that of ``b``.
    """
    at_least, of = share

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            columns = (batch.column(c) for c in ("n_a", "n_b", "members_a", "members_b"))
            for n_a, n_b, x, y in zip(*columns):
                a, b = (np.sort(v.values.to_numpy()) for v in (x, y))
                at = np.searchsorted(b, a)
                same = int(np.count_nonzero(b[np.minimum(at, len(b) - 1)] == a))
                good.append(of * same >= at_least * (n_a.as_py() + n_b.as_py() - same))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    # Never by broadcast: pairs and sets grow with the documents.
    both = pairs
    for side in ("a", "b"):
        own = {"class_id": side, "n": f"n_{side}", "members": f"members_{side}"}
        both = both.join(sets.withColumnsRenamed(own).hint("merge"), side)
    chosen = both.select("a", "b", "n_a", "n_b", "members_a", "members_b")
    return stored(chosen.mapInArrow(verify, "a BIGINT, b BIGINT"))


def with_components(classes: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Classes with their ``component`` so far; one without links is its own."""
    if labels is None:
        return classes.withColumn("component", F.col("class_id"))
    joined = classes.join(labels, F.col("class_id") == F.col("node"), "left")
    return joined.select(*classes.columns, F.coalesce("component", "class_id").alias("component"))


def family_pairs(
    classes: DataFrame, labels: DataFrame | None, first: int, count: int, share: tuple[int, int]
) -> DataFrame:
    """``(a, b)`` of different components that are neighbours by one of ``count`` family members.

    Classes with a member in common are sorted by a hash of member and class.  Very many of them
    are spread over several tasks; neighbours at the tasks' borders do not meet in this round.
    """
    at_least, of = share
    members = with_components(classes, labels).select(
        "class_id", "n", "component", F.explode(F.slice("family", first + 1, count)).alias("token")
    )
    place = F.xxhash64("token", "class_id").alias("place")
    rows = members.select("token", place, "class_id", "n", "component")
    dealt = rows.repartitionByRange(input_tasks(classes.sparkSession), "token", "place")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            table = np.stack([batch.column(c).to_numpy() for c in ("token", "class_id", "n", "component")])
            if last is not None:
                table = np.concatenate((last, table), axis=1)
            (token, class_id, n, component), last = table, table[:, -1:]
            small, large = np.minimum(n[1:], n[:-1]), np.maximum(n[1:], n[:-1])
            good = (token[1:] == token[:-1]) & (component[1:] != component[:-1])
            good &= small * of >= large * at_least
            a, b = class_id[:-1][good], class_id[1:][good]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"]
            )

    return dealt.sortWithinPartitions("token", "place").mapInArrow(meet, "a BIGINT, b BIGINT").distinct()


def _sizes_allow(x: str, y: str, share: tuple[int, int]):
    small, large = F.least(F.col(x), F.col(y)), F.greatest(F.col(x), F.col(y))
    return small * share[1] >= large * share[0]


def open_posts(classes: DataFrame, labels: DataFrame) -> DataFrame:
    """``(token, members, class_id, n, matches, component)`` of prefix members in two components or more.

    Prefix members that occur in one component only (nearly all) leave before any join of classes.
    """
    labelled = stored(with_components(classes.select("class_id", "n", "matches", "prefix"), labels))
    posts = labelled.select("class_id", "n", "matches", "component", F.explode("prefix").alias("token"))
    spread = posts.groupBy("token").agg(
        F.min("component").alias("low"), F.max("component").alias("high"),
        F.count("*").alias("members"), F.min("matches").alias("fewest"),
    )
    shared = spread.where("low < high").select("token", "members", "fewest")
    found = stored(posts.join(shared.hint("merge"), "token"))
    # A class needs as many such members as it, or the least asking class it meets, asks for.
    own = found.groupBy("class_id").agg(
        F.count("*").alias("open"), F.min(F.least("matches", "fewest")).alias("asked")
    )
    enough = own.where("open >= asked").select("class_id")
    return stored(found.join(enough.hint("merge"), "class_id", "left_semi").drop("fewest"))


def candidate_pairs(posts: DataFrame, share: tuple[int, int]) -> DataFrame:
    """``(a, b)`` of different components that share as many prefix members as they must.

    Counted are members in small groups; a pair that shares one in a large group is compared there.
    """
    few = posts.where(F.col("members") <= SMALL_GROUP)
    left, right = (
        few.select("token", *[F.col(c).alias(f"{side}_{c}") for c in ("class_id", "n", "matches", "component")])
        for side in ("a", "b")
    )
    met = left.join(right, "token").where(
        (F.col("a_class_id") < F.col("b_class_id"))
        & (F.col("a_component") != F.col("b_component"))
        & _sizes_allow("a_n", "b_n", share)
    )
    asked = F.min(F.least("a_matches", "b_matches"))
    counted = met.groupBy(F.col("a_class_id").alias("a"), F.col("b_class_id").alias("b")).agg(
        F.count("*").alias("shared"), asked.alias("asked")
    )
    return counted.where("shared >= asked").select("a", "b")


def _blocks_of(classes: Column) -> Column:
    """Number of blocks for so many classes: a class is sent to each of them, so they are not many."""
    few = F.least(F.ceil(classes / BLOCK_CLASSES), F.lit(MOST_BLOCKS))
    return F.greatest(few, F.ceil(classes / LARGEST_BLOCK))


def large_groups(posts: DataFrame) -> DataFrame:
    """``(base, class_id, component, block, blocks)``: classes that share a prefix member in a large group.

    Members with one head are one group, so a family that shares many of them is compared once.
    """
    many = posts.where(F.col("members") > SMALL_GROUP)
    head = F.min(F.struct(F.xxhash64("class_id").alias("place"), "class_id")).alias("head")
    heads = many.groupBy("token").agg(head).select("token", F.col("head.class_id").alias("base"))
    members = stored(many.join(heads, "token").select("base", "class_id", "component").distinct())
    sizes = members.groupBy("base").agg(_blocks_of(F.count("*")).alias("blocks"))
    block = F.pmod(F.xxhash64("class_id", F.lit(1)), "blocks").alias("block")
    return members.join(sizes, "base").select("base", "class_id", "component", block, "blocks")


def block_links(groups: DataFrame, sets: DataFrame, share: tuple[int, int]) -> DataFrame:
    """``(a, b)``: links between classes of a group, a spanning forest per pair of blocks."""
    at_least, of = share
    other = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)).alias("other")
    dealt = groups.select("base", "class_id", "component", "block", other)
    dealt = dealt.join(sets.hint("merge"), "class_id").select(
        "base",
        F.least("block", "other").alias("low"),
        F.greatest("block", "other").alias("high"),
        "class_id", "component", "block", "n", "members",
    )

    def similar(sets_: list[np.ndarray], sizes: np.ndarray) -> np.ndarray:
        """Which pairs of a few sets are linked."""
        owner = np.repeat(np.arange(len(sets_)), [len(x) for x in sets_])
        tokens, place, times = np.unique(np.concatenate(sets_), return_inverse=True, return_counts=True)
        shared = np.flatnonzero(times > 1)  # others are in no intersection
        column = np.full(len(tokens), -1, np.int64)
        column[shared] = np.arange(len(shared))
        place = column[place]
        order = np.argsort(place, kind="stable")
        owner, place = owner[order], place[order]
        same = np.zeros((len(sets_), len(sets_)), np.float32)
        for first in range(0, len(shared), 4096):
            a, b = np.searchsorted(place, (first, first + 4096))
            dense = np.zeros((len(sets_), 4096), np.float32)
            dense[owner[a:b], place[a:b] - first] = 1
            same += dense @ dense.T
        same = same.astype(np.int64)
        return of * same >= at_least * (sizes[:, None] + sizes[None, :] - same)

    def compare(table: pa.Table) -> pa.Table:
        low, high = table.column("low")[0].as_py(), table.column("high")[0].as_py()
        ids, block, n = (table.column(c).to_numpy() for c in ("class_id", "block", "n"))
        component = np.unique(table.column("component").to_numpy(), return_inverse=True)[1]
        root = list(range(int(component.max()) + 1))

        def find(x: int) -> int:
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        members, out = table.column("members"), []
        own, others = np.flatnonzero(block == low), np.flatnonzero(block == high)
        for a in range(0, len(own), TILE):
            for b in range(a if low == high else 0, len(others), TILE):
                left, right = own[a : a + TILE], others[b : b + TILE]
                at = left if low == high and a == b else np.concatenate((left, right))
                good = np.triu(similar([members[i].values.to_numpy() for i in at.tolist()], n[at]), 1)
                good &= component[at][:, None] != component[at][None, :]
                for i, j in zip(*np.nonzero(good)):
                    x, y = find(int(component[at[i]])), find(int(component[at[j]]))
                    if x != y:
                        root[x] = y
                        out.append((int(ids[at[i]]), int(ids[at[j]])))
        return pa.table(
            {"a": pa.array([x for x, _ in out], pa.int64()), "b": pa.array([y for _, y in out], pa.int64())}
        )

    return stored(dealt.groupBy("base", "low", "high").applyInArrow(compare, "a BIGINT, b BIGINT"))


def merged(labels: DataFrame | None, links: DataFrame) -> DataFrame:
    """Components of earlier labels and further links together."""
    if labels is not None:
        known = labels.select(F.col("node").alias("a"), F.col("component").alias("b"))
        links = known.where("a <> b").union(links)
    return components(links)


def row_key(doc_id: str, text: str) -> Column:
    """128 bits of id and text, by which a row is known."""
    both = F.struct(F.col(doc_id), F.col(text))
    return F.struct(F.xxhash64(F.col(doc_id), F.col(text)).alias("k1"), F.xxhash64(F.lit(1), both).alias("k2"))


def near_duplicates(
    docs: DataFrame, n_words: int = 5, share: tuple[int, int] = (80, 100),
    doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """``(doc_id, n_shingles, component_id, class_id, row_key, group)``, a row per input row.

    Two documents are linked if ``share[1] * intersection >= share[0] * union`` of their sets of
    ``n_words``-word n-grams (A-Z lower-cased; words between ASCII white space; a text with
    fewer words is one n-gram).  ``component_id`` is the smallest id that links lead to, the
    document's own included; ``group`` is the same for all documents of a component, NULL ids or
    not.  Texts without words, empty or NULL, are linked with nothing; their ``class_id`` is NULL.
    ``row_key`` are hashes of id and text.  NULL ids are never the smallest, unless a component has
    no other.  Rows repeating id or text are documents as others.  An empty table gives an empty
    result; other columns are not looked at.
    """
    rows = docs.select(
        F.col(doc_id).cast("bigint").alias("doc_id"),
        F.col(text).alias("text"),
        row_key(doc_id, text).alias("row_key"),
    )
    described = stored(document_classes(rows, n_words))
    n_grams = described.agg(F.sum("n").alias("n")).first()["n"] or 0
    classes = stored(open_classes(rows.select("text"), n_words, n_grams, share))
    labels, first = None, 0
    both = F.explode(F.array("a", "b")).alias("class_id")
    for count in FAMILY_ROUNDS:
        pairs = stored(family_pairs(classes, labels, first, count, share))
        labels = merged(labels, linked_pairs(pairs, class_sets(pairs.select(both), classes), share))
        first += count
    posts = open_posts(classes, labels)
    pairs, groups = stored(candidate_pairs(posts, share)), stored(large_groups(posts))
    links = linked_pairs(pairs, class_sets(pairs.select(both), classes), share)
    links = links.union(block_links(groups, class_sets(groups.select("class_id"), classes), share))
    labels = merged(labels, links)
    joined = described.join(labels, F.col("class_id") == F.col("node"), "left")
    # A class without links is its own component, a text without words its own class.
    own = F.concat(F.lit("row "), F.col("row_key.k1"), F.lit(" "), F.col("row_key.k2"))
    group = F.coalesce("component", "class_id").cast("string")
    grouped_rows = stored(
        joined.select(
            "doc_id", F.col("n").alias("n_shingles"), "class_id", "row_key", F.coalesce(group, own).alias("group")
        )
    )
    linked = grouped_rows.where("class_id IS NOT NULL")
    least = linked.groupBy("group").agg(F.min("doc_id").alias("component_id"), F.count("*").alias("size"))
    least = least.where("size > 1").drop("size")
    smallest = F.coalesce("component_id", "doc_id")
    return grouped_rows.join(least, "group", "left").select(
        "doc_id", "n_shingles", smallest.alias("component_id"), "class_id", "row_key", "group"
    )


def distinct_documents(
    docs: DataFrame, n_words: int = 5, share: tuple[int, int] = (80, 100),
    doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """One row of each component of near duplicates, with all columns of ``docs``.

    It is the row with the smallest id, NULL ids last; of rows with one id, texts and NULL ids
    included, the one with the smallest hash of id and text.  Texts without words, which are linked
    with nothing, all stay; rows that repeat id and text are one row.
    """
    found = near_duplicates(docs, n_words, share, doc_id, text)
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row_key")
    stays = found.groupBy("group").agg(F.min(place).alias("first")).select(F.col("first.row_key").alias("__key"))
    keyed = docs.withColumn("__key", row_key(doc_id, text))
    return keyed.join(stays, "__key", "left_semi").dropDuplicates(["__key"]).drop("__key")
