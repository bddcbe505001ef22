"""Near-duplicate groups by order MinHash and banded alignment.

A text is its sequence of words (runs of ASCII letters and digits, lower-cased,
and characters beyond ASCII) and of their k-mers, five consecutive words each,
labelled by occurrence so that every k-mer of a text is distinct. ``HASHES`` hash
functions give as many smallest k-mers; each of ``sketches`` fixed choices of
``minima`` among them, put back into text order, is hashed to a bucket key. Two
texts meet in a bucket if the same k-mers are smallest in both and come in the
same order: at similarity 0.8 all but about 0.2 % of the pairs do.

Candidates are verified by banded alignment of the two k-mer sequences: matches
further than the band from the diagonal cannot be part of a good enough
alignment; the longest increasing chain of the others is the alignment. With L
aligned k-mers of A and B the similarity is L / (A + B - L), an order-aware
Jaccard similarity; texts at ``threshold`` or more are linked. The groups are the
connected components.

Exact copies (equal words) are one class with one set of keys, so thousands of
copies cost one row after pre-aggregation. A bucket of up to ``SMALL`` classes is
compared pair by pair. Of a larger one all members are compared with one hub, the
class that meets most others. The links so far make components; a bucket inside
one component is done. In any other one each open member (outside the bucket's
largest component) meets every member of another component: blocks of open
members and the bucket, both dealt out by salted keys, are sorted next to each
other and compared without a join. A pair is compared in the first bucket it
shares, so each pair that shares a bucket is compared once or lies in one
component already. Hubs with many members are dealt out by salted keys.

Texts without words are alone in their group; texts of fewer than five words are
grouped with exact copies only. Null ids take part and get the group's smallest
other id (null if there is none). Repeated rows are in one group.
"""

from __future__ import annotations

import bisect

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded_batches, map_texts, shared_path, write_table
from .wu_manber import split_words

KMER = 5
#: Bytes of text of one step of a task.
STEP = 4 << 20
HASHES = 96
SKETCHES = 32
MINIMA = 6
THRESHOLD = 0.8
#: Buckets of so many classes are compared pair by pair; open members of a larger one
#: are compared in blocks of about so many.
SMALL, SMALL_FINER = 16, 32
#: Members of one hub, or of a bucket beside one block, that one key takes.
DEALT = 500

_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


_DRAW = np.random.Generator(np.random.PCG64(20))
_ODD = [int(x) | 1 for x in _DRAW.integers(0, 2**64, HASHES, dtype=np.uint64)]


def _choices(count: int, minima: int) -> list[np.ndarray]:
    """The hash functions of each sketch, the same on every worker."""
    draw = np.random.Generator(np.random.PCG64(21))
    return [draw.choice(HASHES, minima, replace=False) for _ in range(count)]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit mixing function."""
    x = (x ^ (x >> np.uint64(30))) * _B
    return x ^ (x >> np.uint64(29))


class Kmers:
    """Word hashes of a batch of texts, and their k-mers labelled by occurrence."""

    def __init__(self, text: pa.Array):
        words, self.first = split_words(text)
        coded = words.dictionary_encode()
        known = np.array([xxhash.xxh64_intdigest(w) for w in coded.dictionary.to_pylist()], dtype=np.uint64)
        self.words = known[coded.indices.to_numpy()] if len(known) else np.zeros(0, np.uint64)
        count = np.maximum(np.diff(self.first) - KMER + 1, 0)
        self.ends = np.r_[0, np.cumsum(count)]
        self.owner = np.repeat(np.arange(len(count)), count)
        at = self.first[:-1][self.owner] + np.arange(self.ends[-1]) - self.ends[:-1][self.owner]
        plain = np.zeros(len(at), dtype=np.uint64)
        for k in range(KMER):
            plain = mix(plain * _A + self.words[at + k])
        order = np.lexsort((plain, self.owner))
        same = np.r_[False, (plain[order][1:] == plain[order][:-1]) & (self.owner[order][1:] == self.owner[order][:-1])]
        starts = np.flatnonzero(~same)
        nth = np.arange(len(order)) - np.repeat(starts, np.diff(np.r_[starts, len(order)]))
        label = np.zeros(len(order), dtype=np.uint64)
        label[order] = nth.astype(np.uint64)
        self.labelled = mix(plain + label * _A)

    def copies(self) -> list[int]:
        """A hash of each text's words, equal for exact copies; null without words."""
        raw, f = self.words.tobytes(), (self.first * 8).tolist()
        return [xxhash.xxh64_intdigest(raw[a:b]) - 2**63 if b > a else None for a, b in zip(f, f[1:])]

    def sketches(self, count: int, minima: int) -> np.ndarray:
        """Bucket keys, one row per text with k-mers, in order of the texts."""
        full = np.flatnonzero(np.diff(self.ends) > 0)
        keys = np.zeros((len(full), count), dtype=np.int64)
        if not len(full):
            return keys
        starts, size = self.ends[:-1][full], np.diff(self.ends)[full]
        # a smallest value brings its place in the text along in its low bits
        bits = max(int(size.max()) - 1, 1).bit_length()
        place = (np.arange(len(self.labelled)) - np.repeat(starts, size)).astype(np.uint64)
        high = ~np.uint64((1 << bits) - 1)
        lowest = np.empty((len(full), HASHES), dtype=np.int64)
        for h in range(HASHES):
            value = self.labelled * np.uint64(_ODD[h])
            value ^= value >> np.uint64(32)
            value *= _B
            value &= high
            value |= place
            lowest[:, h] = (np.minimum.reduceat(value, starts) & ~high).astype(np.int64)
        for r, chosen in enumerate(_choices(count, minima)):
            at = np.sort(lowest[:, chosen], axis=1) + starts[:, None]      # back into text order
            key = np.full(len(full), np.uint64(r), dtype=np.uint64)
            for t in range(minima):
                key = mix(key * _A + self.labelled[at[:, t]])
            keys[:, r] = key.view(np.int64)
        return keys


def alignment(a: np.ndarray, b: np.ndarray, threshold: float, order: np.ndarray | None = None) -> float:
    """Similarity of two sequences of distinct k-mers by banded alignment; 0 if
    it is below what ``threshold`` needs."""
    total = len(a) + len(b)
    if not len(a) or not len(b):
        return 0.0
    needed = threshold * total / (1 + threshold)        # aligned k-mers at the threshold
    if min(len(a), len(b)) < needed:
        return 0.0
    band = total - 2 * needed                           # insertions and deletions it leaves
    order = np.argsort(a, kind="stable") if order is None else order
    at = np.minimum(np.searchsorted(a, b, sorter=order), len(a) - 1)
    place = order[at]
    here = np.flatnonzero(a[place] == b)
    place = place[here]
    place = place[np.abs(place - here) <= band + 1e-9]
    if len(place) < needed:
        return 0.0
    if len(place) > 1 and not (np.diff(place) > 0).all():
        tails: list[int] = []
        for p in place.tolist():
            k = bisect.bisect_left(tails, p)
            if k == len(tails):
                tails.append(p)
            else:
                tails[k] = p
        aligned = len(tails)
    else:
        aligned = len(place)
    return aligned / (total - aligned)


def _classes(docs: DataFrame, id_col: str, text_col: str, sketches: int, minima: int) -> DataFrame:
    """(copy, rep, n, keys): one row per class of exact copies."""
    def make():
        def work(text):
            k = Kmers(text)
            count = np.diff(k.ends)
            keys = k.sketches(sketches, minima)
            ends = np.r_[0, np.cumsum(np.where(count > 0, sketches, 0))].astype(np.int32)
            return [pa.array(k.copies(), pa.int64()), pa.array(count, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(keys.ravel(), pa.int64()))]
        return work
    source = docs.select(F.col(id_col).alias("__o_id"), F.col(text_col).alias("__o_text"))
    found = map_texts(source, "__o_text", "copy long, n long, keys array<long>", make, ["__o_id"], STEP)
    return (found.where("copy IS NOT NULL").groupBy("copy")
            .agg(F.min("__o_id").alias("rep"), F.max("n").alias("n"), F.max("keys").alias("keys")))


def _sequences(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(copy, id, kmers): the k-mer sequence of every text with k-mers."""
    def make():
        def work(text):
            k = Kmers(text)
            small = (k.labelled >> np.uint64(32)).astype(np.uint32).view(np.int32)
            return [pa.array(k.copies(), pa.int64()),
                    pa.ListArray.from_arrays(pa.array(k.ends.astype(np.int32)), pa.array(small))]
        return work
    source = docs.select(F.col(id_col).alias("__o_id"), F.col(text_col).alias("__o_text"))
    return map_texts(source, "__o_text", "copy long, kmers array<int>", make, ["__o_id"], STEP)


def _verified(pairs: DataFrame, kmers: DataFrame, threshold: float) -> DataFrame:
    """(hub, copy, linked) of each distinct pair."""
    load = pairs.groupBy("hub").agg(F.count(F.lit(1)).alias("n"))
    deals = F.floor(F.col("n") / F.lit(DEALT)).cast("int")
    hubs = (load.select("hub", deals.alias("deals")).join(kmers.withColumnRenamed("copy", "hub"), "hub")
            .select("hub", F.col("kmers").alias("left"), F.explode(F.sequence(F.lit(0), "deals")).alias("deal")))
    members = (pairs.join(load.select("hub", deals.alias("deals")), "hub")
               .withColumn("deal", F.pmod(F.xxhash64("copy"), F.col("deals") + 1).cast("int")).drop("deals")
               .join(kmers.withColumnRenamed("kmers", "right"), "copy"))
    both = members.join(hubs, ["hub", "deal"]).select("hub", "copy", "left", "right")

    def run(batches):
        last = (None, None, None)
        for batch in batches:
            hub, copy = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            left, right = batch.column(2), batch.column(3)
            linked = []
            for k, h in enumerate(hub):
                if last[0] != h:
                    a = left[k].values.to_numpy(zero_copy_only=False)
                    last = (h, a, np.argsort(a, kind="stable"))
                b = right[k].values.to_numpy(zero_copy_only=False)
                linked.append(alignment(last[1], b, threshold, last[2]) >= threshold - 1e-12)
            yield pa.RecordBatch.from_arrays([pa.array(hub, pa.int64()), pa.array(copy, pa.int64()),
                                              pa.array(linked, pa.bool_())], names=["hub", "copy", "linked"])

    bounded_batches(pairs.sparkSession)
    return both.mapInArrow(run, "hub long, copy long, linked boolean")


def _crowded(members: DataFrame) -> DataFrame:
    """Members of the buckets that hold several, with ``n``, the bucket's size."""
    sizes = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return members.join(sizes, "bucket")


def _links(classes: DataFrame, members: DataFrame, kmers: DataFrame, threshold: float) -> DataFrame:
    """Links (hub, copy) among the members (bucket, copy) of each bucket: verified,
    and enough of them for the components of all."""
    # weight: how many others a class meets over all its (at most `sketches`) buckets
    weight = F.sum("n").over(Window.partitionBy("copy"))
    members = write_table(_crowded(members).withColumn("weight", weight), "omh-members")
    small = members.where(f"n <= {SMALL}").select("bucket", "copy")
    large = members.where(f"n > {SMALL}").drop("n")
    hubs = large.groupBy("bucket").agg(F.max(F.struct("weight", "copy"))["copy"].alias("hub"))
    stars = large.join(hubs, "bucket").where("copy <> hub")
    trial = (small.join(small.withColumnRenamed("copy", "hub"), "bucket").where("hub < copy").select("hub", "copy")
             .unionByName(stars.select("hub", "copy"))
             .select(F.least("hub", "copy").alias("hub"), F.greatest("hub", "copy").alias("copy")).distinct())
    tested = write_table(_verified(write_table(trial, "omh-pairs"), kmers, threshold), "omh-tested")
    links = tested.where("linked").select("hub", "copy")
    if large.isEmpty():
        return links
    # the hub has met all others of its bucket
    met = stars.select("bucket", "copy").join(components(links), "copy", "left") \
        .select("bucket", "copy", F.coalesce("root", "copy").alias("root"))
    parts = met.groupBy("bucket", "root").agg(F.count(F.lit(1)).alias("n"))
    mixed = (parts.groupBy("bucket").agg(F.max(F.struct("n", "root"))["root"].alias("main"), F.sum("n").alias("n"),
                                         F.max("n").alias("most"), F.count(F.lit(1)).alias("roots"))
             .where("roots > 1")
             .select("bucket", "main", F.ceil((F.col("n") - F.col("most")) / SMALL_FINER).cast("int").alias("blocks"),
                     F.ceil(F.col("n") / DEALT).cast("int").alias("deals")))
    mixed = write_table(met.join(mixed, "bucket").withColumn("open", F.expr("root <> main")).drop("main"), "omh-mixed")
    if mixed.isEmpty():
        return links
    return links.unionByName(write_table(_met_in_blocks(mixed, classes, kmers, threshold), "omh-late"))


def _met_in_blocks(mixed: DataFrame, classes: DataFrame, kmers: DataFrame, threshold: float) -> DataFrame:
    """Links (hub, copy) between the open members of each bucket and its members
    of other components, where they are not linked through others in the block."""
    own = F.xxhash64("copy")
    block, deal = F.pmod(own, F.col("blocks")).cast("int"), F.pmod(own, F.col("deals")).cast("int")
    full = mixed.join(kmers, "copy").join(classes.select("copy", "keys"), "copy")
    rest = ["copy", "root", "open", "keys", "kmers"]
    opened = full.where("open").select("bucket", block.alias("block"), F.lit(0).alias("side"), *rest,
                                       F.explode(F.sequence(F.lit(0), F.col("deals") - 1)).alias("deal"))
    others = full.select("bucket", deal.alias("deal"), F.lit(1).alias("side"), *rest,
                         F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    place = ["bucket", "block", "deal"]
    both = (opened.unionByName(others).select(*place, "side", *rest).repartition(*place)
            .sortWithinPartitions(*place, "side"))

    def run(batches):
        at, held = None, _Block(threshold)
        for batch in batches:
            places = zip(*(batch.column(k).to_pylist() for k in range(3)))
            side, copy, root, opened = (batch.column(k).to_pylist() for k in range(3, 7))
            lists = [(c.offsets.to_numpy(), c.values.to_numpy(zero_copy_only=False))
                     for c in (batch.column(7), batch.column(8))]
            found: list[tuple[int, int]] = []
            for k, here in enumerate(places):
                if here != at:
                    at, held = here, _Block(threshold)
                keys, own = (values[ends[k]:ends[k + 1]] for ends, values in lists)
                if side[k] == 0:
                    held.add(copy[k], root[k], keys, own)
                else:
                    found += held.meet(here[0], copy[k], root[k], opened[k], keys, own)
            yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.int64()),
                                              pa.array([f[1] for f in found], pa.int64())], names=["hub", "copy"])

    bounded_batches(mixed.sparkSession)
    return both.mapInArrow(run, "hub long, copy long")


class _Block:
    """Open members of one bucket, which its other members meet one by one."""

    def __init__(self, threshold: float):
        self.threshold = threshold
        self.copy, self.root, self.keys, self.kmers, self.order = [], [], [], [], []
        self.all_keys: np.ndarray | None = None
        self.joined: dict[int, int] = {}

    def add(self, copy: int, root: int, keys: np.ndarray, kmers: np.ndarray) -> None:
        self.copy.append(copy)
        self.root.append(root)
        self.keys.append(keys.copy())
        self.kmers.append(kmers.copy())
        self.order.append(np.argsort(kmers, kind="stable"))

    def _find(self, root: int) -> int:
        while (above := self.joined.get(root, root)) != root:
            root = above
        return root

    def meet(self, bucket: int, copy: int, root: int, opened: bool, keys: np.ndarray, kmers: np.ndarray):
        """Links of the block's members to this one, without pairs of one component,
        of an earlier shared bucket, or (both open) of the other direction."""
        if self.all_keys is None:
            self.all_keys = np.stack(self.keys)
            self.size = np.array([len(x) for x in self.kmers])
        first = (self.all_keys == keys).argmax(axis=1)
        fit = np.minimum(self.size, len(kmers)) >= self.threshold * np.maximum(self.size, len(kmers)) - 1e-9
        found = []
        for k in np.flatnonzero((keys[first] == bucket) & fit).tolist():
            if opened and self.copy[k] >= copy:
                continue
            a, b = self._find(self.root[k]), self._find(root)
            if a != b and alignment(self.kmers[k], kmers, self.threshold, self.order[k]) >= self.threshold - 1e-12:
                self.joined[a] = b
                found.append((self.copy[k], copy))
        return found


def components(links: DataFrame) -> DataFrame:
    """(copy, root): the smallest node of each linked node's component, by
    alternating large-star and small-star steps."""
    edges = write_table(links.select(F.greatest("hub", "copy").alias("u"), F.least("hub", "copy").alias("v"))
                        .where("u <> v").distinct(), "omh-edges")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")),
                                                             F.struct(F.col("v").alias("u"), F.col("m").alias("v"))))
                                             .alias("e")).select("e.u", "e.v").where("u <> v").distinct())
        edges = write_table(small, "omh-edges")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.select(F.col("u").alias("copy"), F.col("v").alias("root"))
        before = now


def _groups(docs: DataFrame, id_col: str, text_col: str, threshold: float, sketches: int,
            minima: int) -> DataFrame:
    """(copy, rep, root): the group of every class of exact copies."""
    classes = write_table(_classes(docs, id_col, text_col, sketches, minima), "omh-classes")
    members = write_table(_crowded(classes.select(F.explode("keys").alias("bucket"), "copy")).drop("n"), "omh-met")
    # sequences of the classes that meet another one, each from one of its texts
    wanted = (classes.join(members.select("copy").distinct(), "copy", "left_semi")
              .select("copy", F.col("rep").alias("__o_rep")))
    texts = _sequences(docs, id_col, text_col)
    kmers = write_table(texts.join(wanted, (texts["copy"] == wanted["copy"])
                                   & texts["__o_id"].eqNullSafe(wanted["__o_rep"]))
                        .select(texts["copy"], "kmers").dropDuplicates(["copy"]), "omh-kmers")
    roots = components(_links(classes, members, kmers, threshold))
    return classes.select("copy", "rep").join(roots, "copy", "left") \
        .select("copy", "rep", F.coalesce("root", "copy").alias("root"))


def _copies(docs: DataFrame, text_col: str, keep: list[str]) -> DataFrame:
    """Columns ``keep`` and ``__o_copy``, the hash of the text's words."""
    def make():
        return lambda text: [pa.array(Kmers(text).copies(), pa.int64())]
    return map_texts(docs, text_col, "__o_copy long", make, keep, STEP)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD,
                    sketches: int = SKETCHES, minima: int = MINIMA) -> DataFrame:
    """One row per document: its id, ``class_id`` (the smallest id of its group)
    and ``copy_class`` (a hash of its words; null without words)."""
    groups = _groups(docs, id_col, text_col, threshold, sketches, minima)
    heads = groups.groupBy("root").agg(F.min("rep").alias("__o_head"))
    named = groups.join(heads, "root").select("copy", "__o_head")
    copies = _copies(docs.select(id_col, text_col), text_col, [id_col])
    return (copies.join(named, F.col("__o_copy") == F.col("copy"), "left")
            .select(F.col(id_col), F.when(F.col("__o_copy").isNull(), F.col(id_col))
                    .otherwise(F.col("__o_head")).alias("class_id"), F.col("__o_copy").alias("copy_class")))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD,
             sketches: int = SKETCHES, minima: int = MINIMA) -> DataFrame:
    """``docs`` with one document of each group: that of the smallest id (of
    texts that share it, of the smallest word hash), once if it is repeated.
    Texts without words stay, repeated ones once per id."""
    groups = _groups(docs, id_col, text_col, threshold, sketches, minima)
    keys = _copies(docs.select(id_col, text_col), text_col, [id_col]).where("__o_copy IS NOT NULL")
    stays = (keys.join(groups.select("copy", "root"), F.col("__o_copy") == F.col("copy"))
             .groupBy("root").agg(F.min(F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"),
                                                 F.col("copy").alias("copy"))).alias("s"))
             .select(F.col("s.id").alias("__o_id"), F.col("s.copy").alias("__o_stays")))
    whole = _copies(docs, text_col, list(docs.columns))
    return (whole.join(stays, F.col(id_col).eqNullSafe(F.col("__o_id"))
                       & F.col("__o_copy").eqNullSafe(F.col("__o_stays")), "left")
            .where("__o_copy IS NULL OR __o_stays IS NOT NULL")
            .dropDuplicates([id_col, "__o_copy"]).select(*[F.col(f"`{c}`") for c in docs.columns]))
