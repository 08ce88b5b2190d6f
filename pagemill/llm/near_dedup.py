"""MinHash near-duplicates by a signature-coordinate inverted join.

1. Signatures: ``coordinates`` minima of each text's shingle set, each hashed with its coordinate to one
   key, so that a key stands for a coordinate-value pair.  Texts with one and the same set (one 128-bit
   digest) form a class, whose least doc_id stands for it from here on.
2. Postings: classes are posted under their keys.  Two sets of similarity ``s`` are expected to share
   ``s * coordinates`` keys; pairs below ``matches`` of them are left out (``matches`` lies 3.6 standard
   deviations below that at the threshold, so about one true pair in some thousands is missed).
   *Prefix*: keys are ordered by how many classes hold them, rarest first, and a class needs only its first
   ``coordinates - matches + 1``: any pair with enough matches meets there.  Keys of one class alone come
   first, so a text without relatives is left with nothing.  *Skip*: the other, longer lists are never
   merged; a pair from the prefix lists is looked up in the whole signatures to count its matches.
3. Links: a list of n classes needs no n * n / 2 pairs, as only components are asked for.  First each
   class is paired with the least of its list.  What is linked there needs no more pairs; *all* other pairs
   of one list are then compared, whatever their number: those of short lists as candidate rows, those of
   long ones within the join, which gives out links only.  A long list is dealt in blocks of ``BLOCK`` classes,
   and each pair of blocks is a join key of its own, so the work of one list spreads over as many tasks as it
   has pairs of blocks.  So the result is that of all pairs.  Each link is confirmed on the full shingle sets.
4. Components: large and small stars over the links and over the classes that share a doc_id.

Defined results: null and empty texts have ``n_shingles`` 0 and stand alone; a row without doc_id stands
alone and is kept; rows that share a doc_id are one node, so all their texts' classes are in one component;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, join_classes, materialize
from .components import components
from .shingles import Shingler, mix
from .tokens import text_parts
from .worker import drop

COORDINATES = 32
#: Postings of a list up to which candidate pairs are written out.
LONG_LIST = 32
#: Classes of a long list that one side of a join key holds.
BLOCK = 96


def least_matches(similarity: float, coordinates: int) -> int:
    return max(1, math.floor(coordinates * similarity - 3.6 * math.sqrt(coordinates * similarity * (1 - similarity))))


def signatures(docs: DataFrame, width: int, coordinates: int, id_col: str, text_col: str) -> DataFrame:
    """doc_id, n_shingles, digest (null if nothing can be linked) and keys, for each row."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop()
        shingler = Shingler(width)
        draw = np.random.default_rng(20_111)
        factors = draw.integers(1 << 62, size=(2, coordinates), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        for batch in batches:
            for _, part, texts in text_parts(batch, most=250_000):
                ids, rows = part.column(0).to_pylist(), len(texts)
                hashes, count = shingler.shingles([t or "" for t in texts])
                ends = np.cumsum(count)
                full = np.flatnonzero(count)
                keys = np.zeros((rows, coordinates), np.uint64)
                if len(full):
                    room = np.empty_like(hashes)
                    for k in range(coordinates):
                        np.multiply(hashes, factors[0, k], out=room)
                        np.add(room, factors[1, k], out=room)
                        keys[full, k] = np.minimum.reduceat(room, (ends - count)[full])
                    keys = mix(keys ^ factors[1])
                n, digests = [], []
                for i in range(rows):
                    own = np.sort(hashes[ends[i] - count[i] : ends[i]])
                    own = own[np.concatenate([[True], own[1:] != own[:-1]])] if len(own) else own
                    n.append(len(own))
                    digests.append(hashlib.blake2b(own.tobytes(), digest_size=16).digest() if len(own) and ids[i] is not None else None)
                offsets = pa.array(np.arange(0, rows * coordinates + 1, coordinates, dtype=np.int32))
                listed = pa.ListArray.from_arrays(offsets, pa.array(keys.ravel().view(np.int64)))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n, pa.int64()), pa.array(digests, pa.binary()), listed], ["doc_id", "n_shingles", "digest", "keys"])

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return rows.mapInArrow(sign, "doc_id long, n_shingles long, digest binary, keys array<long>")


def full_sets(docs: DataFrame, width: int) -> DataFrame:
    """doc_id and its whole shingle set, of docs (doc_id, text)."""

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop()
        shingler = Shingler(width)
        for batch in batches:
            for _, part, texts in text_parts(batch, most=250_000):
                hashes, count = shingler.shingles([t or "" for t in texts])
                ends = np.cumsum(count)
                own = [np.unique(hashes[e - c : e]).view(np.int64) for e, c in zip(ends, count, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(own, pa.list_(pa.int64()))], ["doc_id", "held"])

    return docs.mapInArrow(collect, "doc_id long, held array<long>")


class _Links:
    """What makes a pair of classes a link."""

    def __init__(self, docs: DataFrame, width: int, percent: int, matches: int):
        self.docs, self.width, self.percent, self.matches = docs, width, percent, matches

    def likely(self, first_only: bool = True):
        """Of two postings of one key (the second's columns with ``b_``): sizes that can do, enough matches in the whole
        signatures, and no earlier key in common, so that a pair comes from one list only."""
        sizes = 100 * F.least("n_shingles", "b_n_shingles") >= self.percent * F.greatest("n_shingles", "b_n_shingles")
        counted = F.size(F.array_intersect("keys", "b_keys")) >= self.matches
        return sizes & (F.element_at(F.array_intersect("prefix", "b_prefix"), 1) == F.col("key")) & counted if first_only else sizes & counted

    def sets(self, reps: DataFrame) -> DataFrame:
        """doc_id and full set of the classes in column ``doc_id``."""
        # written, so that its size is known and few are broadcast instead of all documents being shuffled
        wanted = self.docs.join(materialize(reps.distinct(), "near-wanted"), "doc_id", "left_semi")
        # few of all documents: dealt anew, so that tasks and files are as many as these need
        return materialize(full_sets(wanted.repartition("doc_id"), self.width), "near-sets")

    def enough(self, one, two):
        """Whether two full sets are similar enough."""
        shared = F.size(F.array_intersect(one, two))
        return 100 * shared >= self.percent * (F.size(one) + F.size(two) - shared)

    def confirmed(self, pairs: DataFrame, sets: DataFrame | None = None) -> DataFrame:
        """The pairs (a, b) that are links by their full sets, which are collected if not given."""
        if sets is None:
            pairs = materialize(pairs, "near-candidates")
            sets = self.sets(members(pairs))
        one, two = (sets.select(F.col("doc_id").alias(x), F.col("held").alias(f"s_{x}")) for x in "ab")
        return pairs.join(one, "a").join(two, "b").where(self.enough(F.col("s_a"), F.col("s_b"))).select("a", "b").distinct()


def members(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b"))


def near_duplicates(
    docs: DataFrame,
    width: int = 5,
    percent: int = 80,
    coordinates: int = COORDINATES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row a document: doc_id, n_shingles, component_id, kept.  Links: 100 * intersection >= percent * union."""
    bounded_batches(docs.sparkSession)
    matches = least_matches(percent / 100, coordinates)
    signed = materialize(signatures(docs, width, coordinates, id_col, text_col), "signatures")
    classes = materialize(signed.where("digest is not null").groupBy("digest").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("n")), "near-classes")
    posted = signed.join(classes.select(F.col("digest").alias("c_digest"), "rep"), (F.col("digest") == F.col("c_digest")) & (F.col("doc_id") == F.col("rep")))
    prefix = prefix_postings(posted.select("rep", "n_shingles", "keys"), matches)
    text = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    labels = link_components(prefix, _Links(text, width, percent, matches), shared_ids(signed, classes))
    by_digest = classes.join(labels, classes["rep"] == labels["node"], "left").select("digest", "n", F.coalesce("component", "rep").alias("class_component"))
    out = join_classes(signed.drop("keys"), by_digest, "digest", "n", how="left")
    component = F.coalesce("class_component", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def shared_ids(signed: DataFrame, classes: DataFrame) -> DataFrame:
    """Edges (a, b) between the classes of each doc_id that has several."""
    own = signed.where("digest is not null").select("doc_id", "digest")
    several = own.groupBy("doc_id").agg(F.min("digest").alias("low"), F.max("digest").alias("high")).where("low <> high").select("doc_id")
    reps = own.join(several, "doc_id", "left_semi").distinct().join(classes.select("digest", "rep"), "digest").select("doc_id", "rep")
    least = reps.groupBy("doc_id").agg(F.min("rep").alias("a"))
    return materialize(reps.join(least, "doc_id").where("a <> rep").select("a", F.col("rep").alias("b")).distinct(), "near-shared")


def prefix_postings(reps: DataFrame, matches: int) -> DataFrame:
    """key, rep, n_shingles, keys, prefix: each class under its prefix of the keys that other classes hold too."""
    every = reps.select("rep", F.explode("keys").alias("key"))
    counted = every.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    held = every.join(counted, "key").groupBy("rep").agg(F.sort_array(F.collect_set(F.struct("n", "key"))).alias("held")).where(F.size("held") >= matches)
    # the keys that no other class holds stand before these and use the prefix up
    rare = F.transform(F.slice("held", F.lit(1), F.size("held") - matches + 1), lambda k: k["key"])
    listed = reps.join(held.select("rep", rare.alias("prefix")), "rep")
    return materialize(listed.select(F.explode("prefix").alias("key"), "rep", "n_shingles", "keys", "prefix"), "near-postings")


def link_components(prefix: DataFrame, links: _Links, given: DataFrame) -> DataFrame:
    """node and component of the classes that are linked; ``given``: edges that hold anyway."""
    start = prefix.withColumn("label", F.col("rep"))
    led = materialize(links.confirmed(with_leader(start, links)), "near-led")
    # a class and the least class that it is linked with are in one component, and so are those with one such class
    labels = materialize(led.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("component")), "near-labels")
    now = labelled(prefix, labels)
    mixed = now.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high")
    unresolved = materialize(now.join(mixed.select("key"), "key", "left_semi"), "near-unresolved")
    return components(led.unionByName(given).unionByName(across(unresolved, links)), "near-components")


def labelled(prefix: DataFrame, labels: DataFrame) -> DataFrame:
    return prefix.join(labels, prefix["rep"] == labels["node"], "left").withColumn("label", F.coalesce("component", "rep")).drop("node", "component")


def second(posts: DataFrame, *more: str) -> DataFrame:
    """Postings as the other side of a pair."""
    return posts.select(*[F.col(c).alias(f"b_{c}") for c in ("key", "rep", "label", "n_shingles", "keys", "prefix", *more)])


def with_leader(posts: DataFrame, links: _Links) -> DataFrame:
    """Likely pairs of a class and the least of its list."""
    least = posts.groupBy("key").agg(F.min("rep").alias("rep"))
    led = second(posts.join(least, ["key", "rep"]))
    pairs = posts.join(led, (F.col("key") == F.col("b_key")) & (F.col("rep") != F.col("b_rep")) & links.likely(first_only=False))
    return pairs.select(F.least("rep", "b_rep").alias("a"), F.greatest("rep", "b_rep").alias("b")).distinct()


def across(posts: DataFrame, links: _Links) -> DataFrame:
    """All links between classes of a list whose labels differ; one of a pair at least is outside the list's commonest label.

    Short lists give candidate pairs, at most LONG_LIST for each posting.  Those of longer lists would grow with
    the square of the list, so their postings carry the full sets and the join itself tells links from others.
    """
    # how often each component stands in a list
    tops = posts.groupBy("key", "label").agg(F.count(F.lit(1)).alias("n")).groupBy("key").agg(F.sum("n").alias("size"), F.max(F.struct("n", "label")).alias("top"))
    tops = materialize(tops.select("key", "size", F.col("top.n").alias("alike"), F.col("top.label").alias("top")), "near-tops")
    same = (F.col("key") == F.col("b_key")) & (F.col("label") != F.col("b_label"))
    pair = [F.least("rep", "b_rep").alias("a"), F.greatest("rep", "b_rep").alias("b")]
    short, long = (posts.join(tops.where(when), "key") for when in (F.col("size") <= LONG_LIST, F.col("size") > LONG_LIST))
    pairs = materialize(short.join(second(short.where("label <> top")), same & links.likely()).select(*pair).distinct(), "near-candidates")
    sets = links.sets(members(pairs).union(long.select("rep")))
    found = materialize(links.confirmed(pairs, sets), "near-short")
    full = long.join(sets.withColumnRenamed("doc_id", "rep"), "rep")
    # each side's classes are dealt over its blocks and stand in the block pairs with all of the other's
    blocks = lambda n: F.ceil(n / BLOCK).cast("int")
    dealt = lambda n: F.pmod(F.xxhash64("rep"), blocks(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), blocks(n) - 1))
    outside = F.col("size") - F.col("alike")
    one = full.withColumn("i", dealt(F.col("size"))).withColumn("j", every(outside))
    two = full.where("label <> top").withColumn("j", dealt(outside)).withColumn("i", every(F.col("size")))
    block = (F.col("i") == F.col("b_i")) & (F.col("j") == F.col("b_j"))
    told = one.join(second(two, "held", "i", "j"), block & same & links.likely() & links.enough(F.col("held"), F.col("b_held")))
    return found.unionByName(told.select(*pair)).distinct()


def drop_near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, coordinates: int = COORDINATES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents whose doc_id is the least of its component, and those without doc_id, as they came."""
    found = near_duplicates(docs, width, percent, coordinates, id_col, text_col)
    gone = found.where("not kept").select("doc_id").distinct()
    # the row is one column meanwhile, so that no name can clash
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{id_col}`").cast("long").alias("doc_id"))
    return rows.join(gone, "doc_id", "left_anti").select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
