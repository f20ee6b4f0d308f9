"""Near-duplicate documents: MinHash signatures, banding, verification and connected components."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowloom.llm.components import connected_components
from rowloom.llm.shared import cut_lineage, map_arrow, ship, store
from rowloom.llm.text import shingle_sets

#: Minima of a signature, and how many of them make a band. A pair at similarity 0.75 shares no band with
#: probability (1 - 0.75**4)**32 = 5e-6.
HASHES, BAND = 128, 4
#: Shingles hashed at once, to bound memory on long texts.
CHUNK = 2048
#: Signatures that agree in fewer places are not compared in full: at similarity 0.75 that has probability 1e-6.
LEAST_AGREEING = 72
#: Ids that are broadcast to filter documents: 8 bytes each, 16 MB at most.
BROADCAST_IDS = 2_000_000
#: Rows and bytes of text of one chunk when a group is compared in blocks; shingles in one slab of the comparison.
CHUNK_ROWS, CHUNK_BYTES, SLAB = 256, 1 << 20, 1 << 14

_rng = np.random.default_rng(20240502)
_FACTORS = _rng.integers(1, 2**63, (HASHES, 1), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_TERMS = _rng.integers(0, 2**63, (HASHES, 1), dtype=np.uint64)


def minima(shingles: np.ndarray) -> np.ndarray:
    """The smallest value of each universal hash a*x + b (mod 2**64) over a non-empty set, its upper 32 bits."""
    least = np.full(HASHES, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(shingles), CHUNK):
        hashed = _FACTORS * shingles[at : at + CHUNK] + _TERMS
        np.minimum(least, hashed.min(axis=1), out=least)
    return (least >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        with np.errstate(over="ignore"):
            sizes, digests, signatures = [], [], []
            for found in shingle_sets(batch.column(1)):
                sizes.append(len(found))
                digests.append(blake2b(found.tobytes(), digest_size=16).digest() if len(found) else None)
                signatures.append(minima(found) if len(found) else None)
            columns = [
                batch.column(0),
                pa.array(sizes, pa.int64()),
                pa.array(digests, pa.binary()),
                pa.array(signatures, pa.list_(pa.int32())),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "n_shingles", "digest", "signature"])


def signatures(docs: DataFrame) -> DataFrame:
    """id, n_shingles, digest (of the whole set), signature array<int> of rows (id, text); without words both are null."""
    schema = "id bigint, n_shingles bigint, digest binary, signature array<int>"
    return map_arrow(docs.select("id", "text"), _sign, schema)


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose full shingle sets overlap enough, of columns a, b, text_a, text_b and the threshold in percent."""
    for batch in batches:
        sets = zip(shingle_sets(batch.column(2)), shingle_sets(batch.column(3)), strict=True)
        keep = []
        for (left, right), percent in zip(sets, batch.column(4).to_pylist(), strict=True):
            both = len(np.intersect1d(left, right, assume_unique=True))
            either = len(left) + len(right) - both
            keep.append(either > 0 and 100 * both >= percent * either)
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _named(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The documents with these ids. Up to BROADCAST_IDS ids go to the documents, else both sides are shuffled."""
    named = cut_lineage(ids.distinct())
    return docs.join(F.broadcast(named) if named.count() <= BROADCAST_IDS else named, "id", "left_semi")


def _verified(pairs: DataFrame, signed: DataFrame, docs: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that agree in signature and then in full: a stored table."""
    left = signed.select(F.col("rep").alias("a"), F.col("signature").alias("left"))
    right = signed.select(F.col("rep").alias("b"), F.col("signature").alias("right"))
    agreeing = F.size(F.filter(F.zip_with("left", "right", lambda x, y: x == y), lambda same: same))
    likely = store(
        pairs.distinct().join(left, "a").join(right, "b").where(agreeing >= LEAST_AGREEING).select("a", "b"), "likely"
    )
    texts = store(_named(docs, likely.select(F.explode(F.array("a", "b")).alias("id"))), "texts")
    full = (
        likely.join(texts.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a")
        .join(texts.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b")
        .select("a", "b", "text_a", "text_b", F.lit(percent).alias("percent"))
    )
    return store(map_arrow(full, _confirm, "a bigint, b bigint").distinct(), "links")


def _buckets(signed: DataFrame) -> DataFrame:
    """rep, bucket, members: for each band, the representatives that share its minima with others."""
    bands = F.transform(
        F.sequence(F.lit(0), F.lit(HASHES // BAND - 1)),
        lambda k: F.xxhash64(k, F.slice("signature", k * BAND + 1, BAND)),
    )
    every = signed.select("rep", F.explode(bands).alias("bucket"))
    shared = every.groupBy("bucket").agg(F.count("*").alias("members")).where("members > 1")
    return store(every.join(shared, "bucket"), "buckets")


def _led(buckets: DataFrame) -> DataFrame:
    """bucket, a, b: every member b of a bucket, with the member a that shares the most buckets with others."""
    busy = buckets.groupBy("rep").agg(F.sum("members").alias("company"))
    leader = buckets.join(busy, "rep").groupBy("bucket")
    leader = leader.agg(F.max_by("rep", F.struct("company", -F.col("rep"))).alias("a"))
    return store(buckets.join(leader, "bucket").select("bucket", "a", F.col("rep").alias("b")), "led")


def _apart(led: DataFrame, links: DataFrame) -> DataFrame:
    """a, b, component: members of the buckets that still hold several components, by their leader."""
    found = connected_components(links).withColumnRenamed("node", "b")
    named = led.join(found, "b", "left").withColumn("component", F.coalesce("component", "b"))
    mixed = named.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    mixed = mixed.where("low < high").select("bucket")
    return store(named.join(mixed, "bucket", "left_semi").select("a", "b", "component").distinct(), "apart")


def _overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of every set of one list with every set of the other, a slab of shingles at a time."""
    sets = [*left, *right]
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, shingle, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    common = count[shingle] > 1
    row, shingle = row[common], (np.cumsum(count > 1) - 1)[shingle[common]]
    order = np.argsort(shingle, kind="stable")
    row, shingle = row[order], shingle[order]
    total = np.zeros((len(left), len(right)), dtype=np.int64)
    for begin in range(0, int(shingle[-1]) + 1 if len(shingle) else 0, SLAB):
        a, b = np.searchsorted(shingle, [begin, begin + SLAB])
        held = np.zeros((len(sets), SLAB), dtype=np.float32)
        held[row[a:b], shingle[a:b] - begin] = 1.0
        total += (held[: len(left)] @ held[len(left) :].T).astype(np.int64)
    return total


def _bridges(table: pa.Table) -> pa.Table:
    """Links between components among the members of two chunks of a group: one for each two components at most."""
    same = table["i"][0].as_py() == table["j"][0].as_py()
    sides = []
    for chunk in ("i",) if same else ("i", "j"):
        part = table.filter(pc.equal(table["chunk"], table[chunk]))
        ids, component = part["b"].to_numpy(), part["component"].to_numpy()
        sides.append((ids, component, list(shingle_sets(part["text"]))))
    (left, of_left, sets), (right, of_right, others) = sides[0], sides[-1]
    found = {"a": [], "b": []}
    if len(left) and len(right):
        both = _overlaps(sets, others)
        either = np.array([len(s) for s in sets])[:, None] + np.array([len(s) for s in others])[None, :] - both
        linked = (100 * both >= table["percent"][0].as_py() * either) & (either > 0)
        x, y = np.nonzero(linked & (of_left[:, None] != of_right[None, :]))
        between = np.sort(np.stack([of_left[x], of_right[y]]), axis=0)
        _, first = np.unique(between, axis=1, return_index=True)
        found = {"a": left[x[first]], "b": right[y[first]]}
    return pa.table({name: pa.array(ids, pa.int64()) for name, ids in found.items()})


def _compared(apart: DataFrame, docs: DataFrame, percent: int) -> DataFrame:
    """Links between different components among the members that share a leader, found in blocks: a stored table.

    A group is cut into chunks of bounded rows and bytes, and each two chunks meet in one task, which compares their
    full sets by one product of incidence matrices and returns a link for each two components at most. So a row is
    copied once for every chunk of its group, and pairs are never rows.
    """
    texts = _named(docs, apart.select(F.col("b").alias("id")))
    rows = store(apart.join(texts.withColumnRenamed("id", "b"), "b"), "members")
    sizes = rows.groupBy("a").agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes"))
    chunks = F.ceil(F.greatest(F.col("n") / CHUNK_ROWS, F.col("bytes") / CHUNK_BYTES)).cast("int")
    dealt = rows.join(sizes.select("a", chunks.alias("chunks")), "a")
    dealt = dealt.withColumn("chunk", F.pmod(F.xxhash64("b"), F.col("chunks")).cast("int"))
    dealt = dealt.withColumn("k", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    dealt = dealt.select(
        "a",
        F.least("chunk", "k").alias("i"),
        F.greatest("chunk", "k").alias("j"),
        "chunk",
        "b",
        "component",
        "text",
        F.lit(percent).alias("percent"),
    )
    ship(docs.sparkSession)
    return store(dealt.groupBy("a", "i", "j").applyInArrow(_bridges, "a bigint, b bigint"), "bridges")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = 75) -> DataFrame:
    """key, n_shingles, component_id, kept, n_links for each row of docs.

    Two documents are linked where 100 * intersection >= percent * union of their five-word shingle sets; component_id
    is the smallest key reachable over links, and kept is true for the document that bears it. Texts with equal sets
    are one class, found by a digest of the set, and only the class's representative is searched and verified; n_links
    counts a representative's verified links. Candidates share a band. Each is compared with its bucket's busiest
    member first, so that a large group costs about one pair a member. Where a bucket still holds several components,
    the members that share a leader are compared in blocks; so no link between components is lost.

    Null, empty and wordless texts have no shingles and are linked with nothing. A null key takes part in nothing
    (component_id null, kept true). Rows that repeat a key are one document and share its component. Other columns
    are not read. An empty table gives an empty result.
    """
    texts = docs.select(F.col(key).cast("bigint").alias("id"), F.col(text).alias("text"))
    given = texts.where("id IS NOT NULL")
    signed = store(signatures(texts), "signatures")
    classes = signed.where("id IS NOT NULL AND digest IS NOT NULL").groupBy("digest")
    classes = store(classes.agg(F.min("id").alias("rep"), F.any_value("signature").alias("signature")), "classes")
    members = signed.select("id", "n_shingles", "digest").join(classes.select("digest", "rep"), "digest", "left")
    members = members.withColumn("rep", F.when(F.col("id").isNotNull(), F.coalesce("rep", "id")))
    members = store(members.select("id", "n_shingles", "rep"), "members")

    led = _led(_buckets(classes))
    links = _verified(led.where("a <> b").select("a", "b"), classes, given, percent)
    links = links.union(_compared(_apart(led, links), given, percent))

    twice = members.groupBy("id").agg(F.min("rep").alias("low"), F.max("rep").alias("high")).where("low < high")
    repeated = members.join(twice, "id").select(F.col("rep").alias("a"), F.col("low").alias("b"))
    found = connected_components(links.union(repeated)).withColumnRenamed("node", "rep")
    degree = links.select(F.explode(F.array("a", "b")).alias("rep")).groupBy("rep").agg(F.count("*").alias("n_links"))
    result = members.join(found, "rep", "left").join(degree, "rep", "left")
    component = F.coalesce("component", "rep")
    return result.select(
        F.col("id").alias(key),
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
        F.when(F.col("id") == F.col("rep"), F.coalesce("n_links", F.lit(0))).cast("bigint").alias("n_links"),
    )
