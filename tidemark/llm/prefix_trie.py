"""Prefix trie of conversations by van Emde Boas recursion.

The trie is never walked turn by turn.  Sequences are cut at half their depth:
the part above the cut is an upper trie, each cut prefix is the root of a lower
trie, and both halves are cut again, all of them in the same step, down to
ranges of ``LEAF`` turns that lie in one row.  So a sequence of n turns takes
about log2(n / LEAF) steps, each a few joins on (conversation, range).

1. Naming, upwards and downwards: digests of aligned ranges are joined in
   pairs; then the prefix at each cut is named by the digest of the prefix at
   the cut before and the range between.  Equal prefixes get equal names
   (128 bits of SHA-256).
2. Nodes: the different (depth, name), numbered by their smallest member.  A
   conversation's path is its nodes; the nodes it numbers are a last part of
   its path.
3. Totals: every range of LEAF turns sums its own nodes; then, from the
   smallest ranges to the whole depth, the totals of the lower tries are
   grafted onto the nodes of the upper trie above their cut prefix, along the
   path of the prefix's smallest member.
4. The members that end at a node are sorted by range over all nodes and hashed
   where they lie; a node whose members are in several tasks gives pieces, and
   those alone are put together.

A conversation, a first turn or a whole conversation held by a third of all
rows is split by (conversation, range), pre-aggregated, or met by a join that
can be split; turns are numbered by a range sort, not by a window.

Defined results.  Turns are ordered by turn, nulls first; turns with an equal
number by their digest.  Null roles and texts are empty.  Rows without conv_id
belong to no conversation and are left out.  Repeated rows are turns each.  An
empty table gives no row; otherwise there is always a root.  Extra columns are
ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.store import stored

#: Turns of a range that is not cut further; at least 1.  Results do not depend on it.
LEAF = 4
#: Bytes of member ids that are hashed or handed on at once.
PIECE = 1 << 16
#: Conversations of one base, and the number of turns that a head may have at most, plus 1.
FAMILY, HEADS = 5, 9


def _digest(*parts: Column) -> Column:
    return F.substring(F.sha2(F.concat(*parts), 256), 1, 32)


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the task and each row's place among its conversation's rows of the task."""
    task = TaskContext.get().partitionId()
    last, seen = None, 0
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        c = batch.column(0).to_numpy()
        new = np.append(True, c[1:] != c[:-1])
        first = np.flatnonzero(new)
        at = np.arange(n) - first[np.cumsum(new) - 1]
        if last == c[0]:
            at[:first[1] if len(first) > 1 else n] += seen
        last, seen = c[-1], int(at[-1]) + 1
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(n, task, np.int32)), pa.array(at)],
                                         names=["c", "tok", "bytes", "task", "at"])


def positions(conversations: DataFrame) -> DataFrame:
    """(c, tok, bytes, pos): every turn with its place, from 0, in its conversation."""
    role, text = (F.coalesce(F.col(x).cast("string"), F.lit("")) for x in ("role", "text"))
    turns = conversations.select(
        F.col("conv_id").cast("long").alias("c"), "turn",
        _digest(F.octet_length(role).cast("string"), F.lit(":"), role, text).alias("tok"),
        F.octet_length(text).cast("long").alias("bytes")).where("c is not null")
    order = [F.col("c"), F.col("turn").asc_nulls_first(), F.col("tok")]
    rows = stored(turns.repartitionByRange(*order).sortWithinPartitions(*order).select("c", "tok", "bytes")
                  .mapInArrow(_numbered, "c long, tok string, bytes long, task int, at long"), "trie-turns")
    # one row per task: its first conversation, its last one and how many rows of that it holds
    edges = rows.groupBy("task").agg(F.min("c").alias("first"), F.max(F.struct("c", "at")).alias("end")).select(
        "task", "first", F.col("end.c").alias("last"), (F.col("end.at") + 1).alias("n"))
    by_last = Window.partitionBy("last")
    edges = stored(edges.withColumns({
        "before": F.sum("n").over(by_last.orderBy("task")) - F.col("n"), "all": F.sum("n").over(by_last)}), "trie-edges")
    whole = edges.groupBy(F.col("last").alias("first")).agg(F.max("all").alias("all"))
    shift = edges.drop("all").join(whole, "first", "left").select(
        "task", F.col("first").alias("c"),
        F.when(F.col("first") == F.col("last"), F.col("before")).otherwise(F.coalesce("all", F.lit(0))).alias("shift"))
    # shift has one row per shuffle partition, a setting that does not follow the data
    return rows.join(F.broadcast(shift), ["task", "c"], "left").select(
        "c", "tok", "bytes", (F.col("at") + F.coalesce("shift", F.lit(0))).alias("pos"))


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations (c, len) and turns (c, len, pos, tok, bytes) with the head of each
    taken from the first conversation of its family, as the contract states."""
    head = F.crc32(F.col("c").cast("string")) % HEADS
    convs = turns.groupBy("c").agg(F.count("*").alias("n")).withColumns({"base": F.col("c") - F.col("c") % FAMILY, "h": head})
    bases = convs.where("c = base").select("base", F.col("n").alias("base_n"))
    taken = F.least("h", F.coalesce("base_n", F.lit(0)))
    convs = stored(convs.join(bases, "base", "left").select(
        "c", "base", "h", taken.alias("taken"), (taken + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("len")), "trie-convs")
    heads = turns.where((F.col("c") % FAMILY == 0) & (F.col("pos") < HEADS - 1)).withColumnRenamed("c", "base")
    of_base = convs.where("taken > 0").join(heads, "base").where("pos < h").select("c", "len", "pos", "tok", "bytes")
    own = turns.join(convs, "c").where("pos >= h").select(
        "c", "len", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "tok", "bytes")
    return convs.select("c", "len"), of_base.unionByName(own)


def _levels(ranges: int) -> int:
    """Number of cuts one above the other in so many ranges."""
    return max(0, ranges - 1).bit_length()


def cut_names(chunks: DataFrame, ranges: int, leaf: int) -> DataFrame:
    """(c, j, prefix): the name of each conversation's prefix before its range j, j > 0."""
    followed = chunks.where((F.col("j") + 1) * leaf < F.col("len"))
    blocks = [stored(followed.select("c", "j", _digest(F.array_join("turns.tok", "")).alias("block")), "trie-blocks")]
    for _ in range(1, _levels(ranges)):
        pairs = blocks[-1].groupBy("c", F.shiftright("j", 1).alias("j")).agg(
            F.max(F.when(F.col("j") % 2 == 0, F.col("block"))).alias("left"),
            F.max(F.when(F.col("j") % 2 == 1, F.col("block"))).alias("right"))
        blocks.append(stored(pairs.where("left is not null and right is not null")
                             .select("c", "j", _digest("left", "right").alias("block")), "trie-blocks"))
    names: DataFrame | None = None
    for k in reversed(range(len(blocks))):
        width = 1 << k
        cut = blocks[k].where("j % 2 = 0").select("c", (F.col("j") * width).alias("j"), "block")
        new = cut.where("j = 0").withColumn("prefix", F.lit(""))
        if names is not None:  # the ranges below cuts that have names already
            new = new.unionByName(cut.where("j > 0").join(names, ["c", "j"]))
        new = stored(new.select("c", (F.col("j") + width).alias("j"), _digest("prefix", "block").alias("prefix")), "trie-cuts")
        names = new if names is None else names.unionByName(new)
    return names


def _with_prefix(chunks: DataFrame, ranges: int, leaf: int) -> DataFrame:
    first = chunks.where("j = 0").withColumn("prefix", F.lit(""))
    if ranges <= 1:
        return first
    return first.unionByName(chunks.where("j > 0").join(cut_names(chunks, ranges, leaf), ["c", "j"]))


def paths(turns: DataFrame, root: int, longest: int, leaf: int) -> DataFrame:
    """(c, j, path): the nodes of a conversation's range j in order, after the node
    before the range: structs d, m, n_convs, bytes, childless, last."""
    ranges = -(-longest // leaf)
    chunks = stored(turns.groupBy("c", F.floor(F.col("pos") / leaf).alias("j")).agg(
        F.first("len").alias("len"), F.sort_array(F.collect_list(F.struct("pos", "tok", "bytes"))).alias("turns")), "trie-chunks")
    # names of all prefixes that end in the range: the prefix before it and the turns so far
    tokens = F.col("turns.tok")
    named = F.transform("turns", lambda t, i: F.struct(
        (t["pos"] + 1).alias("d"),
        F.unhex(_digest(F.col("prefix"), F.lit("|"), F.array_join(F.slice(tokens, F.lit(1), i + 1), ""))).alias("name"),
        t["bytes"].alias("bytes"), (t["pos"] + 1 == F.col("len")).alias("last")))
    rows = stored(_with_prefix(chunks, ranges, leaf).select("c", F.inline(named)), "trie-prefixes")
    nodes = rows.groupBy("d", "name").agg(F.min("c").alias("m"), F.count("*").alias("n_convs"),
                                          F.bool_and("last").alias("childless"))
    at = rows.join(nodes, ["d", "name"])
    own = F.floor((F.col("d") - 1) / leaf)
    at = at.select("c", F.explode(F.when((F.col("d") % leaf == 0) & ~F.col("last"), F.array(own, own + 1))
                                  .otherwise(F.array(own))).alias("j"),
                   F.struct("d", "m", "n_convs", "bytes", "childless", "last").alias("node"))
    top = F.struct(F.lit(0).cast("long").alias("d"), F.lit(root).cast("long").alias("m"), F.lit(0).cast("long").alias("n_convs"),
                   F.lit(0).cast("long").alias("bytes"), F.lit(False).alias("childless"), F.lit(False).alias("last"))
    path = F.sort_array(F.collect_list("node"))
    return stored(at.groupBy("c", "j").agg(path.alias("path")).withColumn(
        "path", F.when(F.col("j") == 0, F.concat(F.array(top), "path")).otherwise(F.col("path"))), "trie-paths")


def _range_sums(ranges: DataFrame) -> DataFrame:
    """Per node that lies in a range of its smallest member, or above such a node in
    the range: what is known of it, and its totals within the range."""
    owned = ranges.where(F.element_at("path", -1)["m"] == F.col("c"))
    path, zero = F.col("path"), F.lit(0).cast("long")

    def below(i: Column, value) -> Column:
        """Sum over the range's own nodes from place i (from 0) on."""
        rest = F.filter(F.slice(path, i + 1, F.size(path)), lambda x: x["m"] == F.col("c"))
        return F.aggregate(F.transform(rest, value), zero, lambda a, x: a + x)

    def fact(x: Column, i: Column) -> Column:
        own = (x["m"] == F.col("c")) & (i > 0)
        following = F.get(path, i + 1)
        return F.struct(
            x["d"].alias("d"), x["m"].alias("m"), F.when(own, x["n_convs"]).alias("n_convs"),
            F.when(own, F.get(path, i - 1)["m"]).alias("parent"),
            F.when(following["m"] == F.col("c"), 1).otherwise(0).cast("long").alias("n_children"),
            F.when(i == 0, zero).otherwise(below(i, lambda y: y["childless"].cast("long"))).alias("n_leaves"),
            F.when(i == 0, zero).otherwise(below(i, lambda y: (y["n_convs"] - 1) * y["bytes"])).alias("saved_tokens"))

    facts = owned.select(F.inline(F.transform("path", fact)))
    return facts.groupBy("d", "m").agg(F.max("n_convs").alias("n_convs"), F.max("parent").alias("parent"),
                                       F.sum("n_children").alias("n_children"), F.sum("n_leaves").alias("n_leaves"),
                                       F.sum("saved_tokens").alias("saved_tokens"))


_TOTALS = ("n_leaves", "saved_tokens")


def _grafts(facts: DataFrame, ranges: DataFrame, levels: int, leaf: int) -> list[DataFrame]:
    """(d, m, totals) to be added: per level, what the lower tries bring to the nodes of the upper one."""
    added: list[DataFrame] = []
    for k in range(levels):
        width = 1 << k
        # roots of lower tries: first nodes below cuts at odd multiples of the width
        j = F.floor((F.col("d") - 1) / leaf)
        cut = ((F.col("d") - 1) % leaf == 0) & (j > 0) & (j % width == 0) & (F.floor(j / width) % 2 == 1)
        known = facts.select("d", "m", "parent", *_TOTALS)
        for more in added:
            known = known.unionByName(more.withColumn("parent", F.lit(None).cast("long")))
        lower = known.where(cut).groupBy("d", "m").agg(F.max("parent").alias("parent"), *(F.sum(t).alias(t) for t in _TOTALS))
        low = lower.groupBy(F.col("parent").alias("c"), (F.floor(j / width) - 1).alias("half")).agg(
            *(F.sum(t).alias(t) for t in _TOTALS))
        upper = ranges.select("c", F.floor(F.col("j") / width).alias("half"),
                              F.slice("path", F.lit(2), F.size("path")).alias("path"))
        above = low.join(upper, ["c", "half"]).select(F.explode("path").alias("x"), *_TOTALS)
        added.append(stored(above.groupBy(F.col("x.d").alias("d"), F.col("x.m").alias("m"))
                            .agg(*(F.sum(t).alias(t) for t in _TOTALS)), "trie-grafts"))
    return added


_ENDS = pa.schema([("d", pa.int64()), ("m", pa.int64()), ("c", pa.int64()), ("ids", pa.binary()), ("sha", pa.string())])


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (d, m, c) to one hash per node; the first and last node of a
    task, and those of very many members, to pieces of joined ids."""
    key, first, parts, size, whole = None, 0, [], 0, False
    out: list[dict] = []

    def end(done: bool) -> None:
        ids = b",".join(parts)
        row = {"d": key[0], "m": key[1], "c": first}
        out.append(row | ({"sha": hashlib.sha256(ids).hexdigest()} if done else {"ids": ids}))

    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        d, m, c = (batch.column(i).to_numpy() for i in range(3))
        cuts = np.flatnonzero(np.append(True, (d[1:] != d[:-1]) | (m[1:] != m[:-1]))).tolist()
        step = PIECE // 21
        for a, b in zip(cuts, cuts[1:] + [n]):
            own = (int(d[a]), int(m[a]))
            if own != key:
                if key is not None and parts:
                    end(whole)
                whole = key is not None  # the task's first node may have begun in another task
                key, parts, size = own, [], 0
            for lo in range(a, b, step):
                if size > PIECE:
                    end(False)
                    parts, size, whole = [], 0, False
                first = first if parts else int(c[lo])
                ids = ",".join(map(str, c[lo:min(b, lo + step)].tolist())).encode()
                parts.append(ids)
                size += len(ids)
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=_ENDS)
            out.clear()
    if parts:
        end(False)  # the last node may go on in another task
        yield pa.RecordBatch.from_pylist(out, schema=_ENDS)


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces sorted by (d, m, c) to one hash per node; holds the hash's state alone."""
    key, state = None, None
    for batch in batches:
        out = []
        for d, m, ids in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3))):
            if (d, m) == key:
                state.update(b",")
            else:
                if key is not None:
                    out.append((*key, state.hexdigest()))
                key, state = (d, m), hashlib.sha256()
            state.update(ids)
        if out:
            yield _hashes(out)
    if key is not None:
        yield _hashes([(*key, state.hexdigest())])


def _hashes(rows: list[tuple[int, int, str]]) -> pa.RecordBatch:
    d, m, sha = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(d, pa.int64()), pa.array(m, pa.int64()), pa.array(sha)], names=["d", "m", "sha"])


def ends_hashes(ends: DataFrame) -> DataFrame:
    """(d, m, sha): SHA-256 of the ascending, comma-joined c of each (d, m)."""
    rows = ends.select("d", "m", "c").repartitionByRange("d", "m", "c").sortWithinPartitions("d", "m", "c")
    pieces = stored(rows.mapInArrow(_pieces, "d long, m long, c long, ids binary, sha string"), "trie-ends")
    split = pieces.where("ids is not null").repartition("d", "m").sortWithinPartitions("d", "m", "c")
    return pieces.where("sha is not null").select("d", "m", "sha").unionByName(
        split.mapInArrow(_joined, "d long, m long, sha string"))


_OUT = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
        "ends_sha256 string")


def trie(convs: DataFrame, turns: DataFrame, leaf: int = LEAF) -> DataFrame:
    """Nodes of the trie of conversations (c, len) with turns (c, len, pos, tok, bytes)."""
    spark = convs.sparkSession
    every = convs.agg(F.min("c").alias("root"), F.max("len").alias("longest"), F.count("*").alias("n")).first()
    if not every["n"]:
        return spark.createDataFrame([], _OUT)
    ranges = paths(turns, every["root"], every["longest"], leaf)
    facts = stored(_range_sums(ranges), "trie-facts")
    grafts = _grafts(facts, ranges, _levels(-(-every["longest"] // leaf)), leaf)

    at_root = [F.lit(0).cast("long").alias("d"), F.lit(every["root"]).cast("long").alias("m")]
    ends = (ranges.select("c", F.explode(F.slice("path", F.lit(2), F.size("path"))).alias("x")).where("x.last")
            .select("x.d", "x.m", "c").unionByName(convs.where("len = 0").select(*at_root, "c")))
    parts = [facts, ends_hashes(ends), spark.range(1).select(*at_root, F.lit(every["n"]).cast("long").alias("n_convs"))]
    parts += grafts
    parts += [p.where("d = 1").select(*at_root, *_TOTALS) for p in (facts, *grafts)]  # the root's children
    all_parts = parts[0]
    for p in parts[1:]:
        all_parts = all_parts.unionByName(p, allowMissingColumns=True)
    nodes = all_parts.groupBy("d", "m").agg(
        F.max("parent").alias("parent"), F.max("n_convs").alias("n_convs"),
        *(F.coalesce(F.sum(t), F.lit(0)).alias(t) for t in ("n_children", *_TOTALS)), F.max("sha").alias("sha"))
    return nodes.select(
        F.col("m").alias("conv_id"), F.col("d").alias("depth"), F.col("parent").alias("parent_conv_id"), "n_convs", "n_children",
        F.greatest("n_leaves", (F.col("n_children") == 0).cast("long")).alias("n_leaves"), "saved_tokens",
        F.coalesce("sha", F.sha2(F.lit(""), 256)).alias("ends_sha256"))


def prefix_trie(conversations: DataFrame, leaf: int = LEAF) -> DataFrame:
    """Nodes of the trie of all rebuilt conversations."""
    return trie(*rebuilt(positions(conversations)), leaf)
