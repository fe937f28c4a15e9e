"""Prefix trie of conversations by truncation peeling over sorted runs, and one merge of the nodes that cross runs."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lossloom.llm.common import slices
from lossloom.session import materialise

DIGEST = 16
SPAN, MOST = 100, 6  # conversations that share an opening; an opening has fewer turns than MOST
CLOSED, WAITING, PARTIAL = 0, 1, 2
NODES = ("kind int, part int, chunk int, side int, depth int, digest binary, parent binary, conv_id long, parent_conv_id long, n_convs long, "
         "n_children long, n_leaves long, saved long, tail long, ends binary")
NODE_NAMES = [field.split()[0] for field in NODES.split(", ")]
NO_ENDS = sha256(b"").hexdigest()


def paths(turns: DataFrame, span: int = SPAN, most: int = MOST) -> DataFrame:
    """(conv_id, path binary, tails array<int>): the rebuilt turns of every conversation as one digest each, and their lengths.

    Texts are replaced by 16 bytes of their SHA-256 before anything is shuffled. Turns of one number are ordered by digest.
    """
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    content = F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text)
    turn = F.struct("turn", F.substring(F.sha2(content, 256), 1, 2 * DIGEST).alias("digest"), F.char_length(text).alias("tail"))
    own = materialise(turns.filter("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("t"))
                      .groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns")))
    openings = own.filter(F.col("conv_id") % span == 0).select(
        F.col("conv_id").alias("base"), F.slice("turns", 1, most - 1).alias("opening"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("int")
    both = own.join(openings, F.col("conv_id") - F.col("conv_id") % span == F.col("base"), "left")
    nothing: Column = F.slice("turns", 1, F.lit(0))
    rebuilt = both.select("conv_id", F.concat(
        F.slice(F.coalesce("opening", nothing), F.lit(1), h), F.slice("turns", h + 1, F.size("turns"))).alias("turns"))
    return rebuilt.select("conv_id", F.unhex(F.array_join(F.transform("turns", lambda t: t["digest"]), "")).alias("path"),
                          F.transform("turns", lambda t: t["tail"]).alias("tails"))


def shared_turns(a: bytes, b: bytes) -> int:
    """Turns that two paths have in common at their start."""
    low, high = 0, min(len(a), len(b)) // DIGEST
    if a[:high * DIGEST] == b[:high * DIGEST]:
        return high
    while low < high - 1:
        middle = (low + high) // 2
        if a[low * DIGEST:middle * DIGEST] == b[low * DIGEST:middle * DIGEST]:
            low = middle
        else:
            high = middle
    return low


def path_digests(path: bytes) -> list[bytes]:
    """Digest of the node at every depth of a path, from the root."""
    total = sha256()
    out = [total.digest()[:DIGEST]]
    for k in range(0, len(path), DIGEST):
        total.update(path[k:k + DIGEST])
        out.append(total.copy().digest()[:DIGEST])
    return out


def peel(keys: list[bytes], convs: np.ndarray, tails: list[list[int]], part: int, chunk: int) -> dict[str, list]:
    """Nodes of one sorted run of conversations, from the deepest up.

    At depth d the conversations that end there join the nodes that survive from depth d + 1, whose last turn is stripped; neighbours
    that share d turns are one node. A node that holds the first or the last row of the run may go on in other runs: it is given
    as a partial row for that side, with what its finished children add up to. Children of such a node wait for its conv_id.
    """
    rows = len(keys)
    size = np.array([len(k) // DIGEST for k in keys])
    lcp = np.array([-1, *(shared_turns(a, b) for a, b in zip(keys, keys[1:]))])
    edges = (path_digests(keys[0]), path_digests(keys[-1]))
    by_size = np.argsort(size, kind="stable")
    bound = np.searchsorted(size[by_size], np.arange(int(size.max()) + 2))
    out: dict[str, list] = {name: [] for name in NODE_NAMES}
    none = np.empty(0, np.int64)
    # Survivors of the depth below: first row, members, smallest member, children, leaves, saved, finished, ended rows.
    old = {c: none for c in ("start", "n", "least", "children", "leaves", "saved", "ended")} | {"shut": np.empty(0, bool)}

    def give(depth: int, kind: int, side: int, **values) -> None:
        values = {"part": part, "chunk": chunk, "kind": kind, "side": side, "depth": depth, **values}
        for name, column in out.items():
            column.append(values.get(name))

    def finished(depth: int, nodes: dict, parent_conv: np.ndarray, parent_open: np.ndarray) -> None:
        for k in np.flatnonzero(nodes["shut"]).tolist():
            start, ended = int(nodes["start"][k]), int(nodes["ended"][k])
            ends = sha256(",".join(map(str, convs[start:start + ended].tolist())).encode()).digest() if ended else None
            waits = bool(parent_open[k])
            side = 0 if waits and lcp_first[start] >= depth - 1 else 1
            give(depth, WAITING if waits else CLOSED, side, parent=edges[side][depth - 1] if waits else None, conv_id=int(nodes["least"][k]),
                 parent_conv_id=None if waits else int(parent_conv[k]), n_convs=int(nodes["n"][k]), n_children=int(nodes["children"][k]),
                 n_leaves=int(nodes["leaves"][k]), saved=int(nodes["saved"][k]), ends=ends)

    # Turns that every row shares with the first one.
    lcp_first = np.minimum.accumulate(np.r_[size[0], lcp[1:]])
    for d in range(int(size.max()), -1, -1):
        new = by_size[bound[d]:bound[d + 1]]
        start = np.r_[old["start"], new]
        order = np.argsort(start, kind="stable")
        start = start[order]
        first = np.flatnonzero(lcp[start] < d)
        group = np.cumsum(lcp[start] < d) - 1

        def total(column: np.ndarray, fresh: int | np.ndarray, how=np.add) -> np.ndarray:
            return how.reduceat(np.r_[column, np.broadcast_to(fresh, len(new))][order], first)

        now = {"start": start[first], "n": total(old["n"], 1), "least": total(old["least"], convs[new], np.minimum),
               "ended": total(np.zeros(len(old["n"]), np.int64), 1),
               "children": total(np.ones(len(old["n"]), np.int64), 0)}
        shut_children = total(old["shut"].astype(np.int64), 0)
        leaves, saved = (total(np.where(old["shut"], old[c], 0), 0) for c in ("leaves", "saved"))
        tail = np.array([tails[s][d - 1] if d else 0 for s in now["start"].tolist()], np.int64)
        at_first, at_last = now["start"] == 0, now["start"] + now["n"] == rows
        now["shut"] = ~(at_first | at_last)
        now["leaves"] = leaves + (now["children"] == 0)
        now["saved"] = saved + (now["n"] - 1) * tail
        place = np.empty(len(order), np.int64)
        place[order] = group
        mine = place[:len(old["n"])]
        finished(d + 1, old, now["least"][mine], ~now["shut"][mine])
        for side, held in ((0, at_first), (1, at_last)):
            if d >= len(edges[side]):
                continue
            k = int(np.flatnonzero(held)[0])
            again = side == 1 and bool(at_first[k])
            ended = 0 if again else int(now["ended"][k])
            ids = convs[int(now["start"][k]):int(now["start"][k]) + ended].tolist()
            give(d, PARTIAL, side, digest=edges[side][d], parent=edges[side][d - 1] if d else None, conv_id=int(now["least"][k]),
                 n_convs=0 if again else int(now["n"][k]), n_children=0 if again else int(shut_children[k]),
                 n_leaves=0 if again else int(leaves[k]), saved=0 if again else int(saved[k]), tail=int(tail[k]),
                 ends=",".join(map(str, ids)).encode() if ids else None)
        old = now
    return out


def peeled(ordered: DataFrame, rows_a_run: int) -> DataFrame:
    """peel() over the runs of every sorted partition."""
    target = ordered.sparkSession.createDataFrame([], NODES).schema
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(target)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, chunk = TaskContext.get().partitionId(), 0
        for batch in batches:
            for slab in slices(batch):
                for start in range(0, slab.num_rows, rows_a_run):
                    piece = slab.slice(start, rows_a_run)
                    yield pa.RecordBatch.from_pydict(peel(piece["path"].to_pylist(), piece["conv_id"].to_numpy(), piece["tails"].to_pylist(), part, chunk), schema=arrow)
                    chunk += 1

    return ordered.mapInArrow(run, target)


def joined_ends(pieces: DataFrame) -> DataFrame:
    """(node, ends_sha256) from comma-joined pieces in the order of their runs; pieces stream through the hash one at a time."""
    width = int(pieces.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = pieces.select("digest", "part", "chunk", "ends").repartition(width, "digest").sortWithinPartitions("digest", "part", "chunk")
    schema = pa.schema([("node", pa.binary()), ("ends_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, total = None, None
        for batch in batches:
            found: list[tuple] = []
            for node, piece in zip(batch["digest"].to_pylist(), batch["ends"]):
                if node != now:
                    if now is not None:
                        found.append((now, total.hexdigest()))
                    now, total = node, sha256()
                else:
                    total.update(b",")
                total.update(piece.as_py())
            yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.binary()), pa.array([f[1] for f in found], pa.string())], schema=schema)
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now], pa.binary()), pa.array([total.hexdigest()], pa.string())], schema=schema)

    return ordered.mapInArrow(run, "node binary, ends_sha256 string")


def prefix_trie(turns: DataFrame, span: int = SPAN, most: int = MOST, rows_a_run: int = 4096) -> DataFrame:
    """One row for each node of the trie of `turns(conv_id, turn, role, text)` after openings have been shared.

    Conversations are ordered by path and id over range partitions, so a node is one stretch of rows however many conversations it has, and copies
    of one conversation spread over partitions. Runs of `rows_a_run` rows are peeled alone; only nodes at the ends of runs are merged
    afterwards. Null roles and texts are empty, null turns come first, turns with one number are ordered by the SHA-256 of role and text,
    repeated rows are turns of their own. Rows without a conv_id belong to no conversation and are left out. A conversation is one row of 16
    bytes a turn, whatever the length of its texts. An empty table has no node. Other columns are not read.
    """
    spark = turns.sparkSession
    found = materialise(paths(turns, span, most))
    width = max(int(spark.conf.get("spark.sql.shuffle.partitions")), found.rdd.getNumPartitions())
    ordered = found.repartitionByRange(width, "path", "conv_id").sortWithinPartitions("path", "conv_id")
    nodes = materialise(peeled(ordered, rows_a_run))

    partial = nodes.filter(F.col("kind") == PARTIAL)
    home = F.struct("part", "chunk", "side")
    merged = partial.groupBy("digest").agg(
        F.min("depth").alias("depth"), F.min("parent").alias("parent"), F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"),
        F.sum("n_children").alias("shut"), F.sum("n_leaves").alias("leaves"), F.sum("saved").alias("below"), F.max("tail").alias("tail"),
        F.min(home).alias("home"))
    merged = materialise(merged)
    kids = merged.filter("parent is not null").groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("open"))
    children = F.col("shut") + F.coalesce("open", F.lit(0))
    merged = materialise(merged.join(kids, F.col("digest") == F.col("node"), "left").drop("node").withColumns({
        "n_children": children, "own_leaves": F.col("leaves") + (children == 0).cast("long"),
        "own_saved": F.col("below") + (F.col("n_convs") - 1) * F.col("tail")}))
    # A merged node counts on one of the edge paths that pass it; running sums up each path and a sum over paths give subtrees.
    up = Window.partitionBy("part", "chunk", "side").orderBy(F.desc("depth"))
    at_home = F.struct("part", "chunk", "side") == F.col("home")
    sums = (partial.select("part", "chunk", "side", "depth", "digest").join(merged.select("digest", "home", "own_leaves", "own_saved"), "digest")
            .select("digest", *(F.sum(F.when(at_home, F.col(f"own_{c}")).otherwise(0)).over(up).alias(c) for c in ("leaves", "saved")))
            .groupBy(F.col("digest").alias("node")).agg(F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens")))
    above = merged.select(F.col("digest").alias("above"), F.col("conv_id").alias("parent_conv_id"))
    ends = joined_ends(partial.filter("ends is not null"))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    crossing = (merged.join(sums, F.col("digest") == F.col("node")).drop("node").join(above, F.col("parent") == F.col("above"), "left")
                .join(ends, F.col("digest") == F.col("node"), "left"))
    # Within a run a waiting node meets its parent's row, so no run brings more rows to it than it has conversations.
    owners = partial.select("part", "chunk", "digest").distinct().join(merged.select("digest", F.col("conv_id").alias("owner")), "digest")
    waiting = nodes.filter(F.col("kind") == WAITING).drop("digest").join(
        owners.withColumnRenamed("digest", "parent"), ["part", "chunk", "parent"]).withColumn("parent_conv_id", F.col("owner"))
    inside = nodes.filter(F.col("kind") == CLOSED).unionByName(waiting.select(*[c for c in nodes.columns if c != "digest"], F.lit(None).cast("binary").alias("digest")))
    inside = inside.withColumns({"saved_tokens": F.col("saved"), "ends_sha256": F.lower(F.hex("ends"))})
    both = [d.select("conv_id", F.col("depth").cast("long").alias("depth"), *columns[2:-1], F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"))
            for d in (crossing, inside)]
    return both[0].unionByName(both[1])
