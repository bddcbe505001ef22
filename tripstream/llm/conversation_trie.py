"""Prefix trie of conversations as a Z-fast trie in tables.

A conversation is a sequence of turns. Every turn has a digest, every prefix a
chained digest (SHA-256, 16 bytes of it, taken as equality), so the first d turns
of two conversations are equal if their d-th prefix digests are. Conversations
that are equal as a whole are one *sequence* with their number.

The trie is compacted: a node stands for an edge of depths (low, ext], and
branches or ends sequences only at ``ext``. Its key in the hash table is the
prefix digest at its *handle*, the two-fattest depth of (low, ext]: the one
divisible by the greatest power of two. Sequences are inserted in batches, all
that are left at a time:

1. locate: a fat binary search over (lo, hi] probes the table with the prefix at
   the two-fattest depth. A hit whose extent the sequence has moves lo to that
   extent, a hit that it leaves inside the edge ends the search at the edge's
   top, a miss moves hi below the probe. Each step is one equi-join of the
   sequences with the handles; the number of steps is that of the bits of the
   greatest depth.
2. exit: the edge that begins with the sequence's next turn, if there is one, and
   the depth p up to which the sequence follows it.
3. insert: edges are cut at every p where a sequence leaves or ends, and of the
   sequences that leave with the same next turn the one with the least digest
   hangs its remaining turns below p as a new edge. The others of that turn go
   on to the next batch, and find themselves deeper. The digest picks at random,
   so the batches are about the logarithm of the sequences that share a prefix.

``expand`` turns edges into one row per depth. Sums and minima over subtrees go
up the paths of the nodes, combined before they are shuffled.

A conversation is one row of some 24 bytes a turn; a turn's text is reduced to
its digest and word count where it is read, so its length does not matter. Null
roles and texts are empty ones, null turns come first, turns of equal number are
ordered by their digest and each of several equal rows is a turn. Rows without a
``conv_id`` belong to no conversation. Other columns are not read. An empty
table has no node.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import remove_table, store_table, write_table

ROOT = hashlib.sha256(b"").digest()[:16]
#: Ids of one row of ``ends_digests``: conversation numbers within such a span.
ID_SPAN = 4096


def conversation_turns(rows: DataFrame, id_col: str = "conv_id", order_col: str = "turn", role_col: str = "role",
                       text_col: str = "text") -> DataFrame:
    """One row per conversation: ``conv_id`` and ``turns``, an array of (digest,
    words) in order."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    whole = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    digest = F.substring(F.unhex(F.sha2(whole.cast("binary"), 256)), 1, 16)
    words = F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")
    turn = F.struct(F.col(order_col).alias("at"), digest.alias("digest"), words.alias("words"))
    return (rows.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("conv_id"), turn.alias("t"))
            .groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("t"))
            .select("conv_id", F.transform("t", lambda t: F.struct(t["digest"], t["words"])).alias("turns")))


def prefix_paths(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``path`` (digest of each prefix) and ``total`` (words up to each
    turn) of conversations with ``turns``."""
    def run(batches):
        for batch in batches:
            lists, words = batch.column(1), batch.column(2)
            ends = lists.offsets.to_numpy()
            made = []
            flat, counts = lists.values.to_pylist(), words.values.to_numpy()
            total = np.zeros(len(counts), np.int64)
            for a, b in zip(ends[:-1], ends[1:]):
                node = ROOT
                for digest in flat[a:b]:
                    node = hashlib.sha256(node + digest).digest()[:16]
                    made.append(node)
                total[a:b] = np.cumsum(counts[a:b])
            first, last = int(ends[0]), int(ends[-1])
            cuts = pa.array(ends - first, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(cuts, pa.array(made, pa.binary())),
                 pa.ListArray.from_arrays(cuts, pa.array(total[first:last]))], names=["conv_id", "path", "total"])

    flat = conversations.select("conv_id", F.col("turns.digest").alias("digests"), F.col("turns.words").alias("words"))
    kind = conversations.schema["conv_id"].dataType.simpleString()
    return flat.mapInArrow(run, f"conv_id {kind}, path array<binary>, total array<long>")


def sequences(paths: DataFrame) -> DataFrame:
    """Distinct sequences: ``node`` (digest of the whole), ``n`` turns, ``path``,
    ``total``, ``n_convs`` conversations, the least ``conv_id`` as ``first``."""
    whole = F.coalesce(F.try_element_at("path", F.lit(-1)), F.lit(ROOT))
    return (paths.groupBy(whole.alias("node"))
            .agg(F.first("path").alias("path"), F.first("total").alias("total"), F.count(F.lit(1)).alias("n_convs"),
                 F.min("conv_id").alias("first")).withColumn("n", F.size("path")))


def fattest(low: str, high: str) -> Column:
    """The depth of (low, high] that the greatest power of two divides."""
    return F.expr(f"CAST(({high}) & shiftleft(-1, length(bin(({low}) ^ ({high}))) - 1) AS int)")


def locate(pending: DataFrame, trie: DataFrame, steps: int) -> DataFrame:
    """Fat binary search: ``pending`` with ``lo``, the extent of the deepest node
    that its path passes through."""
    handles = trie.select(F.get("path", fattest("low", "ext") - 1).alias("_handle"), F.col("node").alias("_node"),
                          F.col("low").alias("_low"), F.col("ext").alias("_ext"))
    kept = pending.columns
    found = pending.withColumn("hi", F.col("n"))
    for _ in range(steps):
        open_ = F.col("lo") < F.col("hi")
        found = found.withColumn("_at", F.when(open_, fattest("lo", "hi")))
        # a settled sequence probes with its own digest: spread, and not looked at
        found = found.withColumn("_probe", F.coalesce(F.get("path", F.col("_at") - 1), "node"))
        found = found.join(handles, F.col("_probe") == F.col("_handle"), "left")
        hit = F.col("_at").isNotNull() & F.col("_handle").isNotNull()
        whole = F.coalesce(F.get("path", F.col("_ext") - 1) == F.col("_node"), F.lit(False))
        found = found.select(
            *[c for c in kept if c != "lo"],
            F.when(hit & whole, F.col("_ext")).when(hit, F.col("_low")).otherwise(F.col("lo")).alias("lo"),
            F.when(hit & whole, F.col("hi")).when(hit, F.col("_low")).when(F.col("_at").isNotNull(), F.col("_at") - 1)
            .otherwise(F.col("hi")).alias("hi"))
    return found.select(*kept)


def exits(located: DataFrame, trie: DataFrame) -> DataFrame:
    """``located`` with ``edge`` (node of the edge that the path leaves or ends
    on, null for none) and ``p``, the depth up to which the trie has the path."""
    edges = trie.select(F.get("path", F.col("low")).alias("_start"), F.col("node").alias("_edge"), F.col("ext").alias("_ext"),
                        F.slice("path", F.col("low") + 1, F.col("ext") - F.col("low")).alias("_way"))
    joined = located.withColumn("_next", F.coalesce(F.get("path", F.col("lo")), "node"))
    joined = joined.join(edges, F.col("_next") == F.col("_start"), "left")
    on = (F.col("lo") < F.col("n")) & F.col("_edge").isNotNull()
    # prefix digests are equal up to the depth of parting and never after it
    common = F.expr("size(filter(sequence(lo + 1, least(n, _ext)), d -> path[d - 1] = _way[d - lo - 1]))")
    return joined.select(*located.columns, F.when(on, F.col("_edge")).alias("edge"),
                         F.when(on, F.col("lo") + common).otherwise(F.col("lo")).alias("p"))


def _insert(trie: DataFrame, left: DataFrame, new: DataFrame) -> DataFrame:
    """``trie`` with the edges that ``left`` parts from cut there, and ``new`` edges."""
    cuts = (left.where("edge IS NOT NULL").select(F.col("edge").alias("node"), "p")
            .groupBy("node").agg(F.collect_set("p").alias("_cuts")))
    none = F.array().cast("array<int>")
    cut = trie.join(cuts, "node", "left").withColumn(
        "_to", F.array_distinct(F.concat(F.array_sort(F.coalesce("_cuts", none)), F.array("ext"))))
    cut = cut.select("*", F.posexplode("_to").alias("_k", "_until"))
    pieces = cut.select(F.when(F.col("_k") > 0, F.get("_to", F.col("_k") - 1)).otherwise(F.col("low")).alias("low"),
                        F.col("_until").alias("ext"), F.slice("path", F.lit(1), F.col("_until")).alias("path"),
                        F.slice("total", F.lit(1), F.col("_until")).alias("total"))
    both = pieces.unionByName(new)
    return both.withColumn("node", F.element_at("path", -1))


def build(found: DataFrame) -> DataFrame:
    """The compacted trie of sequences: ``node``, ``low``, ``ext`` and the ``path``
    and ``total`` of each node up to ``ext``. The root is not among them."""
    spark = found.sparkSession
    pending, pending_at = store_table(found.where("n > 0").select("node", "n", "path", "total", F.lit(0).alias("lo")),
                                      "trie-pending")
    trie, trie_at = None, None
    while True:
        now = pending.agg(F.count(F.lit(1)).alias("rows"), F.max(F.expr("length(bin(lo ^ n))")).alias("steps")).first()
        if not now["rows"]:
            break
        if trie is None:
            left, left_at = pending.withColumns({"edge": F.lit(None).cast("binary"), "p": F.lit(0)}), None
        else:
            left, left_at = store_table(exits(locate(pending, trie, now["steps"]), trie), "trie-exits")
        on = left.where("p < n")
        first = on.groupBy(F.get("path", F.col("p"))).agg(F.min_by(F.struct("node", "n", "path", "total", "p"), "node").alias("s"))
        new = first.select(F.col("s.p").alias("low"), F.col("s.n").alias("ext"), "s.path", "s.total")
        old_at = trie_at
        grown = new.withColumn("node", F.element_at("path", -1)) if trie is None else _insert(trie, left, new)
        trie, trie_at = store_table(grown, "trie")
        rest = on.join(first.select("s.node"), "node", "left_anti").select("node", "n", "path", "total", F.col("p").alias("lo"))
        done_at = pending_at
        pending, pending_at = store_table(rest, "trie-pending")
        for path in (old_at, left_at, done_at):
            if path:
                remove_table(spark, path)
    remove_table(spark, pending_at)
    if trie is None:
        schema = "low int, ext int, path array<binary>, total array<long>, node binary"
        return spark.createDataFrame([], schema)
    return trie


def expand(trie: DataFrame, found: DataFrame) -> DataFrame:
    """Every node of the trie, one per distinct prefix: ``node``, ``conv_id`` (least
    member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``,
    ``n_leaves``, ``saved_tokens`` (of the subtree, (n_convs - 1) times the words
    of each node's turn)."""
    children = trie.groupBy(F.coalesce(F.get("path", F.col("low") - 1), F.lit(ROOT)).alias("node")) \
        .agg(F.count(F.lit(1)).alias("n_children"))
    ended = found.join(children, "node", "left").select(
        "path", "n_convs", "first", F.col("n_children").isNull().cast("long").alias("leaf"))
    # of every prefix with the root's; the trie's nodes keep theirs
    up = (ended.select("n_convs", "first", "leaf", F.explode(F.concat(F.array(F.lit(ROOT)), "path")).alias("node"))
          .groupBy("node").agg(F.sum("n_convs").alias("n_convs"), F.min("first").alias("first"), F.sum("leaf").alias("n_leaves")))
    up = write_table(up.join(trie.select("node").unionByName(trie.sparkSession.createDataFrame([(ROOT,)], "node binary")),
                             "node", "left_semi").join(children, "node", "left")
                     .withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long"))), "trie-sums")
    before = F.coalesce(F.get("total", F.col("low") - 1), F.lit(0).cast("long"))
    sized = trie.join(up, "node").withColumn("own", (F.col("n_convs") - 1) * (F.element_at("total", -1) - before))
    below = (sized.select("own", F.explode(F.concat(F.array(F.lit(ROOT)), "path")).alias("node"))
             .groupBy("node").agg(F.sum("own").alias("saved")))
    top = up.where(F.col("node") == F.lit(ROOT)).join(below, "node", "left").select(
        "node", F.col("first").alias("conv_id"), F.lit(0).cast("long").alias("depth"),
        F.lit(None).cast(up.schema["first"].dataType).alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
        F.coalesce("saved", F.lit(0).cast("long")).alias("saved_tokens"))
    parents = up.select(F.col("node").alias("_parent"), F.col("first").alias("_parent_first"))
    whole = sized.join(below, "node").withColumn("_parent", F.coalesce(F.get("path", F.col("low") - 1), F.lit(ROOT))) \
        .join(parents, "_parent").withColumn("_before", before)
    rows = whole.select("*", F.explode(F.sequence(F.col("low") + 1, F.col("ext"))).alias("d"))
    rows = rows.withColumn("_until", F.coalesce(F.get("total", F.col("d") - 2), F.lit(0).cast("long")))
    inner = rows.select(
        F.element_at("path", F.col("d")).alias("node"), F.col("first").alias("conv_id"), F.col("d").cast("long").alias("depth"),
        F.when(F.col("d") == F.col("low") + 1, F.col("_parent_first")).otherwise(F.col("first")).alias("parent_conv_id"),
        "n_convs", F.when(F.col("d") == F.col("ext"), F.col("n_children")).otherwise(F.lit(1).cast("long")).alias("n_children"),
        "n_leaves", (F.col("saved") - (F.col("n_convs") - 1) * (F.col("_until") - F.col("_before"))).alias("saved_tokens"))
    return top.unionByName(inner)


def ends_digests(paths: DataFrame) -> DataFrame:
    """``node`` and ``ends_sha256``: of the conversations that end at a node, the ids
    in ascending order, joined by commas. Ids come in rows of those of one
    ``ID_SPAN``, and a digest is fed row by row."""
    whole = F.coalesce(F.try_element_at("path", F.lit(-1)), F.lit(ROOT))
    spans = (paths.groupBy(whole.alias("node"), F.floor(F.col("conv_id") / ID_SPAN).alias("span"))
             .agg(F.array_sort(F.collect_list("conv_id")).alias("ids"))
             .select("node", "span", F.array_join(F.col("ids").cast("array<string>"), ",").alias("ids")))

    def run(batches):
        node, digest = None, None
        for batch in batches:
            nodes, out = batch.column(0).to_pylist(), []
            for now, ids in zip(nodes, batch.column(1).to_pylist()):
                if now == node:
                    digest.update(b"," + ids.encode())
                    continue
                if node is not None:
                    out.append((node, digest.hexdigest()))
                node, digest = now, hashlib.sha256(ids.encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in out], pa.binary()), pa.array([b for _, b in out])],
                                                 names=["node", "ends_sha256"])
        if node is not None:
            yield pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([digest.hexdigest()])],
                                             names=["node", "ends_sha256"])

    return (spans.repartition("node").sortWithinPartitions("node", "span").select("node", "ids")
            .mapInArrow(run, "node binary, ends_sha256 string"))


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """All nodes of the trie of conversations (``conv_id``, ``turns``), see ``expand``,
    with ``ends_sha256``."""
    paths = write_table(prefix_paths(conversations), "trie-paths")
    found = write_table(sequences(paths), "trie-sequences")
    nodes = expand(build(found), found)
    none = hashlib.sha256(b"").hexdigest()
    return nodes.join(ends_digests(paths), "node", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(none)))
