"""Near-duplicate texts by SimHash fingerprints and Golay keys, or by shingle sets.

A fingerprint's 64 bits are cut into three segments of at most 22 bits, each padded to a
Golay word. Fingerprints that differ in few bits share keys; only rows with a common
key are compared, and every link is verified. Near copies by Jaccard similarity, which
fingerprints find only in part, have the first shingles of their sets as keys.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import golay
from .common import pieces, query, table, written
from .components import components

SEED = 42
#: First bit and width of the segments, from the low end.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
#: Buckets of more rows are not compared pairwise at once; see the users' notes.
SMALL_BUCKET = 16


def shingles(text: str | None, k: int) -> Iterator[list[bytes]]:
    """Lists of the text's k-word shingles in order; of fewer words, all of them as one."""
    carried: list[bytes] = []
    seen = False
    for piece in pieces((text or "").encode("utf-8", "surrogatepass").lower()):
        words = carried + piece.split()
        found = list(map(b" ".join, zip(*(words[i:] for i in range(k)))))
        if found:
            seen = True
            yield found
            carried = words[len(words) - k + 1 :] if k > 1 else []
        else:
            carried = words
    if not seen and carried:
        yield [b" ".join(carried)]


def hashes(items: list[bytes]) -> np.ndarray:
    found = map(xxhash.xxh64_intdigest, items, repeat(SEED))
    return np.fromiter(found, np.uint64, len(items))


def fingerprint(parts: Iterator[np.ndarray]) -> int:
    """Bits set in over half of all hashes, as a signed long; 0 without hashes."""
    sums, n = np.zeros(64, np.int64), 0
    for part in parts:
        for start in range(0, len(part), 1 << 15):
            block = part[start : start + (1 << 15)].astype(">u8")
            bits = np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1)
            sums += bits.sum(axis=0, dtype=np.int64)
            n += len(block)
    return int(np.packbits(2 * sums > n).view(">i8")[0])


def shingle_fingerprint(text: str | None, k: int) -> int:
    """Over all k-word shingles, repeats included."""
    return fingerprint(hashes(found) for found in shingles(text, k))


def shingle_set(text: str | None, k: int) -> np.ndarray:
    """Sorted hashes of the distinct k-word shingles."""
    parts = [np.unique(hashes(found)) for found in shingles(text, k)]
    return np.unique(np.concatenate(parts)) if parts else np.zeros(0, np.uint64)


def fingerprints(docs: DataFrame, k: int = 3) -> DataFrame:
    """doc_id and fp (long) of every row; null and blank texts have fp 0."""
    key = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingle_fingerprint(t.as_py(), k) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.int64())], names=["doc_id", "fp"]
            )

    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(
        run, f"doc_id {key}, fp bigint"
    )


def segment(fp: np.ndarray, which: int) -> np.ndarray:
    first, width = SEGMENTS[which]
    return (fp.view(np.uint64) >> np.uint64(first)).astype(np.int64) & ((1 << width) - 1)


def close_keys(fp: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, keys): fingerprints at most 2 bits apart share a key.

    One of three segments has no error then; the key is that segment as it is with a
    Golay key of the next segment, which stands the 2 errors it may have.
    """
    for zero in range(3):
        exact = segment(fp, zero)
        near = golay.keys(segment(fp, (zero + 1) % 3))
        rows, columns = np.nonzero(near >= 0)
        yield rows, (zero << 36) | (exact[rows] << 12) | near[rows, columns]


def keyed(nodes: DataFrame) -> DataFrame:
    """(key, id, fp) rows of nodes (id, fp)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 2048):
                part = batch.slice(start, 2048)
                ids = part.column(0).to_numpy(zero_copy_only=False)
                fp = part.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
                for rows, found in close_keys(fp):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(found), pa.array(ids[rows]), pa.array(fp[rows])],
                        names=["key", "id", "fp"],
                    )

    return nodes.select("id", "fp").mapInArrow(run, "key bigint, id bigint, fp bigint")


def bits_apart(x: Column, y: Column) -> Column:
    return F.bit_count(x.bitwiseXOR(y))


def shared_buckets(rows: DataFrame) -> DataFrame:
    """Key rows whose key has others, with the bucket's size ``n``."""
    sizes = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    return written(rows.join(sizes.where(F.col("n") > 1), "key"), "buckets")


def shared_sets(rows: DataFrame) -> DataFrame:
    """Key rows whose key another id has too, each once, with the bucket's size ``n``."""
    sizes = rows.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), F.min("id").alias("_low"), F.max("id").alias("_high")
    )
    sizes = sizes.where(F.col("_low") < F.col("_high")).select("key", "n")
    return written(rows.join(sizes, "key").distinct(), "buckets")


Near = Callable[[Column, Column], Column]


def small_pairs(buckets: DataFrame, fields: tuple[str, ...], near: Near) -> DataFrame:
    """Pairs (a, b) that are ``near`` by their fields in buckets of up to SMALL_BUCKET rows."""
    lists = (
        buckets.where(F.col("n") <= SMALL_BUCKET)
        .groupBy("key")
        .agg(F.collect_list(F.struct("id", *fields)).alias("m"))
    )
    pairs = F.flatten(
        F.transform(
            "m",
            lambda x, i: F.transform(
                F.filter(F.slice("m", i + 2, SMALL_BUCKET), lambda y: near(x, y)),
                lambda y: F.struct(
                    F.least(x["id"], y["id"]).alias("a"), F.greatest(x["id"], y["id"]).alias("b")
                ),
            ),
        )
    )
    return lists.select(F.inline(pairs)).distinct()


def midpoint_links(crowd: DataFrame) -> DataFrame:
    """Links (a, b) that join all of ``crowd`` (id, fp) at most 2 bits apart, without pairs.

    Each fingerprint is dealt to itself and its 64 one-bit neighbours. Those that meet
    at a place are at most 2 bits apart, and those at most 2 bits apart meet; all of a
    place are linked to its smallest id.
    """
    places = F.array(
        F.col("fp"), *[F.col("fp").bitwiseXOR(F.lit(1 << b if b < 63 else -(1 << 63))) for b in range(64)]
    )
    dealt = crowd.select("id", F.explode(places).alias("place"))
    first = dealt.groupBy("place").agg(F.min("id").alias("a"), F.count(F.lit(1)).alias("n"))
    return (
        dealt.join(first.where(F.col("n") > 1), "place")
        .where(F.col("id") != F.col("a"))
        .select("a", F.col("id").alias("b"))
        .distinct()
    )


def simhash_groups(docs: DataFrame, k: int = 3) -> DataFrame:
    """doc_id, fp and component_id of every row; links are fingerprints at most 2 bits apart.

    component_id is the smallest doc_id reachable over links, itself included. Equal
    fingerprints are one node, so copies never meet pairwise. In buckets of up to
    ``SMALL_BUCKET`` nodes all pairs are verified; nodes of larger buckets are linked at
    their midpoints, which is exact as well. Null and blank texts share fingerprint 0
    and are linked like others. A row with a null doc_id gets the component of its
    fingerprint, null if no row of it has an id; repeated rows repeat.
    """
    return _grouped(written(fingerprints(docs, k), "fingerprints"))


def _grouped(marks: DataFrame) -> DataFrame:
    """doc_id, fp and component_id of rows (doc_id, fp); see :func:`simhash_groups`."""
    nodes = written(
        marks.groupBy("fp").agg(F.min("doc_id").alias("first")).withColumn("id", F.col("fp")),
        "nodes",
    )
    buckets = shared_buckets(keyed(nodes))
    crowd = buckets.where(F.col("n") > SMALL_BUCKET).select("id", "fp").distinct()
    links = written(
        small_pairs(buckets, ("fp",), lambda x, y: bits_apart(x["fp"], y["fp"]) <= 2)
        .unionByName(midpoint_links(crowd))
        .distinct(),
        "simhash-links",
    )
    roots = components(links)
    named = nodes.join(roots, nodes["id"] == roots["node"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    least = named.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = named.join(least, "root").select(F.col("fp").alias("class_fp"), "component_id")
    return marks.join(classes, marks["fp"] == classes["class_fp"], "left").select(
        "doc_id", "fp", "component_id"
    )


def drop_simhash_copies(docs: DataFrame, k: int = 3) -> DataFrame:
    """``docs`` without those that have a smaller id in their group of fingerprints.

    Rows with a null doc_id stay. Rows that repeat a doc_id are one document, for which the
    least of their fingerprints stands, and stay or go together.
    """
    rows = docs.where(F.col("doc_id").isNotNull())
    marks = fingerprints(rows, k).groupBy("doc_id").agg(F.min("fp").alias("fp"))
    groups = _grouped(written(marks, "fingerprints"))
    gone = groups.where(F.col("component_id") != F.col("doc_id")).select(F.col("doc_id").alias("_gone"))
    gone = _ids(written(gone, "simhash-gone"))
    return docs.join(gone, docs["doc_id"] == gone["_gone"], "left_anti")


@dataclass(frozen=True)
class Settings:
    """Near copies: Jaccard of ``k``-word shingles of ``similarity`` or more."""

    k: int = 5
    similarity: float = 0.8


def _described(docs: DataFrame) -> DataFrame:
    """doc_id and two hashes of the words in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            same, other = [], []
            for value in batch.column(1):
                whole = xxhash.xxh3_128()
                for found in shingles(value.as_py(), 1):
                    whole.update(b" ".join(found) + b" ")
                digest = np.frombuffer(whole.digest(), ">i8")
                same.append(int(digest[0]))
                other.append(int(digest[1]))
            columns = [pa.array(x, pa.int64()) for x in (same, other)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *columns], names=["doc_id", "same", "other"]
            )

    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(
        run, "doc_id bigint, same bigint, other bigint"
    )


#: So many documents at least, and one in so many, are looked at for common shingles, so
#: many of which are kept. A share of the table and not a number of documents, so that what
#: counts as common, and with it a bucket, does not grow with the table. They decide in which
#: order sets are read, that is the work, not what is found.
SAMPLED, SAMPLED_SHARE, COMMON = 4_096, 20, 100_000


def common_shingles(texts: DataFrame, n: int, k: int) -> np.ndarray:
    """Hashes of common shingles in ``n`` texts (doc_id, text), the rarer ones first."""
    step = max(1, min(n // SAMPLED, SAMPLED_SHARE))
    share = F.pmod(F.xxhash64(F.lit("sample"), "doc_id"), F.lit(step))
    some = _shingle_sets(texts.where(share == 0), k).select(F.explode("set").alias("h"))
    counts = some.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 3)
    found = [r["h"] for r in counts.orderBy(F.desc("n"), "h").limit(COMMON).collect()]
    return np.array(found[::-1], np.int64).view(np.uint64)


Common = tuple[np.ndarray, np.ndarray]


def placed(common: np.ndarray) -> Common:
    """Shingles sorted by hash, and the place each had."""
    places = np.argsort(common)
    return common[places], places


def first_shingles(found: np.ndarray, common: Common, similarity: float) -> np.ndarray:
    """The shingles of which sets of the similarity have one in common, in the order of all.

    That order is rare ones by hash, then ``common``. Of a set x at least similarity * |x|
    shingles are in the other set; so many cannot all stand behind the first |x| minus
    that plus one, and of those the first one shared stands there in both sets.
    """
    names, places = common
    if len(names):
        at = np.minimum(np.searchsorted(names, found), len(names) - 1)
        late = names[at] == found
        order = np.argsort(places[at[late]])
        found = np.concatenate([found[~late], found[late][order]])
    return found[: len(found) - math.ceil(similarity * len(found) - 1e-6) + 1]


def _keyed_sets(texts: DataFrame, common: Common, settings: Settings) -> DataFrame:
    """(key, id, size, pos) of each text's first shingles: its set's size, places from 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                part = batch.slice(start, 64)
                sets = [shingle_set(t.as_py(), settings.k) for t in part.column(1)]
                keys = [first_shingles(x, common, settings.similarity) for x in sets]
                counts = [len(x) for x in keys]
                ids = part.column(0).to_numpy(zero_copy_only=False)
                columns = [
                    pa.array(np.concatenate(keys).view(np.int64)),
                    pa.array(np.repeat(ids, counts), pa.int64()),
                    pa.array(np.repeat([len(x) for x in sets], counts).astype(np.int32)),
                    pa.array(np.concatenate([np.arange(n, dtype=np.int32) for n in counts])),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["key", "id", "size", "pos"])

    return texts.select("doc_id", "text").mapInArrow(run, "key bigint, id bigint, size int, pos int")


def may_reach(similarity: float) -> Near:
    """Whether two sets can reach the similarity if theirs is the first shingle they share.

    All that they share stands from there on in both.
    """
    share = similarity / (1 + similarity)

    def near(x: Column, y: Column) -> Column:
        most = F.least(x["size"] - x["pos"], y["size"] - y["pos"])
        return most >= share * (x["size"] + y["size"]) - 1e-6

    return near


#: Up to so many ids are sent to all tasks; more are joined by a shuffle.
BROADCAST_IDS = 1_000_000


def _ids(ids: DataFrame) -> DataFrame:
    """A written table of ids, marked for broadcast if its counted rows allow it."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def _shingle_sets(docs: DataFrame, k: int, slices: int = 1) -> DataFrame:
    """id, digest and size of each text's set, and its shingles that ``slices`` divides."""
    kinds = [pa.int64(), pa.int32(), pa.list_(pa.int64())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                part = batch.slice(start, 64)
                sets = [shingle_set(t.as_py(), k) for t in part.column(1)]
                found = (
                    np.array([xxhash.xxh64_intdigest(x.tobytes()) for x in sets], np.uint64).view(np.int64),
                    [len(x) for x in sets],
                    [x[x % np.uint64(slices) == 0].view(np.int64) for x in sets],
                )
                columns = [pa.array(x, t) for x, t in zip(found, kinds)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *columns], names=["id", "digest", "size", "set"]
                )

    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(
        run, "id bigint, digest bigint, size int, set array<bigint>"
    )


#: A pair's sets are first compared in one of so many slices.
SLICES = 5


def _compared(rows: DataFrame, pairs: DataFrame, settings: Settings, slices: int) -> DataFrame:
    """The pairs (a, b) that reach the similarity if all beyond the slice may agree."""
    wanted = pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct()
    wanted = _ids(written(wanted, "near-wanted"))
    texts = rows.select("doc_id", "text").join(wanted, "doc_id", "left_semi")
    # Rows that repeat an id are one document; the least of their sets stands for them.
    sets = _shingle_sets(texts, settings.k, slices).groupBy("id")
    sets = sets.agg(F.min(F.struct("digest", "size", "set")).alias("s"))
    # Not written: the joins go on in the aggregate's partitions.
    left = sets.select(F.col("id").alias("a"), F.col("s.size").alias("m"), F.col("s.set").alias("x"))
    right = sets.select(F.col("id").alias("b"), F.col("s.size").alias("n"), F.col("s.set").alias("y"))
    rest = F.least(F.col("m") - F.size("x"), F.col("n") - F.size("y"))
    common = F.size(F.array_intersect("x", "y")) + rest
    return (
        pairs.join(left, "a")
        .join(right, "b")
        .where(common >= settings.similarity * (F.col("m") + F.col("n") - common))
        .select("a", "b")
    )


def _alike(rows: DataFrame, pairs: DataFrame, settings: Settings) -> DataFrame:
    """The pairs (a, b) whose shingle sets reach the similarity.

    A slice of the sets rules out most others, so few whole sets are sent around.
    """
    likely = written(_compared(rows, pairs, settings, SLICES), "near-likely")
    return _compared(rows, likely, settings, 1)


def led(crowded: DataFrame, fields: tuple[str, ...], near: Near) -> DataFrame:
    """Pairs (a, b) of each crowded bucket's leader with the others that are near it.

    The leader stands in most crowded buckets: of edited copies the original does, as
    each edit takes a copy out of some.
    """
    known = crowded.groupBy("id").agg(F.count(F.lit(1)).alias("known"))
    first = crowded.join(known, "id").groupBy("key")
    first = first.agg(
        F.max_by(F.struct("id", *fields), F.struct("known", -F.col("id"))).alias("x")
    )
    met = crowded.select("key", F.struct("id", *fields).alias("y")).join(first, "key")
    return met.where((F.col("x.id") != F.col("y.id")) & near(F.col("x"), F.col("y"))).select(
        F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b")
    ).distinct()


#: Rows of a crowded bucket are dealt into parts of about so many.
BUCKET_PART = 128
#: A row knows so many of its id's crowded keys, the first ones.
KNOWN_KEYS = 32


def unlinked_pairs(
    crowded: DataFrame, roots: DataFrame, fields: tuple[str, ...], near: Near,
    repeated: DataFrame | None = None,
) -> DataFrame:
    """Pairs (a, b) near in crowded buckets (key, id, n) that components do not join yet."""
    met = unlinked_meetings(crowded, roots, fields, near, repeated)
    return met.select(
        F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b")
    ).distinct()


def unlinked_meetings(
    crowded: DataFrame, roots: DataFrame, fields: tuple[str, ...], near: Near,
    repeated: DataFrame | None = None,
) -> DataFrame:
    """Rows (x, y) of :func:`unlinked_pairs`, in which a pair is seldom repeated.

    A bucket is dealt into parts; each two parts meet by themselves, so a large bucket
    is spread over tasks. Edited copies share most of their keys: two ids meet in the
    first bucket they share, and not in others if that is one of the first
    ``KNOWN_KEYS`` of both. First goes by ``pos`` if there is one, whose order is the
    same in all sets, as ``near`` holds for the first shared key only. The ids of
    ``repeated`` have keys of several sets, and meet in every bucket.
    """
    rooted = crowded.join(roots, crowded["id"] == roots["node"], "left").select(
        *crowded.columns, F.coalesce("root", "id").alias("root")
    )
    rooted = written(rooted, "near-crowd")
    mixed_keys = rooted.groupBy("key").agg(F.min("root").alias("r"), F.max("root").alias("s"))
    mixed_keys = mixed_keys.where(F.col("r") != F.col("s")).select("key")
    parts = F.ceil(F.col("n") / BUCKET_PART)
    rooted = rooted.join(mixed_keys, "key").withColumns(
        {
            "parts": parts, "part": F.pmod(F.xxhash64("id"), parts),
            "at": F.col("pos" if "pos" in fields else "key"),
        }
    )
    keys = F.slice(F.sort_array(F.collect_list(F.struct("at", "key"))), 1, KNOWN_KEYS)
    alone = rooted if repeated is None else rooted.join(repeated, "id", "left_anti")
    rooted = rooted.join(alone.groupBy("id").agg(keys.alias("keys")), "id", "left")
    before = F.transform(F.filter("keys", lambda k: k["at"] < F.col("at")), lambda k: k["key"])
    rooted = rooted.withColumn("before", F.coalesce(before, F.array().cast("array<bigint>")))
    low = rooted.select(
        "key", F.col("part").alias("low"), F.explode(F.sequence("part", F.col("parts") - 1)).alias("high"),
        F.struct("id", "root", "before", *fields).alias("x"),
    )
    high = rooted.select(
        "key", F.explode(F.sequence(F.lit(0).cast("long"), "part")).alias("low"), F.col("part").alias("high"),
        F.struct("id", "root", "before", *fields).alias("y"),
    )
    return low.join(high, ["key", "low", "high"]).where(
        (F.col("x.root") != F.col("y.root"))
        & ((F.col("low") < F.col("high")) | (F.col("x.id") < F.col("y.id")))
        & near(F.col("x"), F.col("y"))
        & ~F.arrays_overlap("x.before", "y.before")
    )


def near_copy_groups(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """doc_id and ``keeper`` of every document with an id: the smallest id of its group.

    Documents of the same words in the same order are one node, named by the smallest
    id. Nodes are candidates if the first shingles of their sets, rare ones before
    common ones, have one in common, as those of any two that reach the similarity do;
    they are linked if the whole sets reach it. In buckets of more than
    ``SMALL_BUCKET`` nodes each is compared with one leader first, then with all that
    these links have not joined it to; a pair left out is in one group already. Texts of
    fewer than ``k`` words (also null) match only texts of the same words.
    """
    rows = docs.where(F.col("doc_id").isNotNull()).withColumn("doc_id", F.col("doc_id").cast("long"))
    marks = written(_described(rows), "near-marks")
    nodes = marks.groupBy("same", "other").agg(F.min("doc_id").alias("id"))
    nodes = written(nodes, "near-nodes")
    texts = rows.select("doc_id", F.col("text").cast("string").alias("text")).join(
        _ids(nodes.select(F.col("id").alias("doc_id")).distinct()), "doc_id", "left_semi"
    )
    common = placed(common_shingles(texts, nodes.count(), settings.k))
    buckets = shared_sets(_keyed_sets(texts, common, settings))
    crowded = buckets.where(F.col("n") > SMALL_BUCKET)
    by = ("size", "pos"), may_reach(settings.similarity)
    pairs = small_pairs(buckets, *by).unionByName(led(crowded, *by)).where(F.col("a") != F.col("b"))
    pairs = written(pairs.distinct(), "near-pairs")
    links = written(_alike(rows, pairs, settings), "near-links")
    texts_of = marks.groupBy("doc_id").agg(F.countDistinct("same", "other").alias("texts"))
    repeated = written(texts_of.where(F.col("texts") > 1).select(F.col("doc_id").alias("id")), "near-repeated")
    pairs = written(unlinked_pairs(crowded, components(links), *by, repeated), "near-pairs")
    if not pairs.isEmpty():
        links = links.unionByName(_alike(rows, pairs, settings))
    roots = components(links)
    least = roots.groupBy("root").agg(F.min("node").alias("keeper"))
    grouped = roots.join(least, "root").select("node", "keeper")
    members = marks.select("doc_id", "same", "other").join(
        nodes.select("same", "other", "id"), ["same", "other"]
    )
    out = members.join(grouped, members["id"] == grouped["node"], "left")
    return out.select("doc_id", F.coalesce("keeper", "id").alias("keeper"))


def drop_near_copies(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``docs`` without the documents that have a keeper other than themselves.

    Rows with a null doc_id stay; rows that repeat a doc_id are one document and stay
    or go together.
    """
    groups = near_copy_groups(docs, settings)
    gone = groups.groupBy("doc_id").agg(F.min("keeper").alias("keeper"))
    gone = gone.where(F.col("keeper") != F.col("doc_id")).select(F.col("doc_id").alias("_gone"))
    gone = _ids(written(gone, "near-gone"))
    return docs.join(gone, docs["doc_id"] == gone["_gone"], "left_anti")


@query("op4_simhash_golay")
def simhash_golay(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint and component of every document."""
    groups = simhash_groups(table(spark, folder, "documents"), 3)
    return groups.select(
        "doc_id",
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        "component_id",
    )
