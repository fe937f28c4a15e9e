"""SimHash near-duplicates: fingerprints of word shingles, compared bit-sliced inside small cells, grouped by components."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lossloom.llm.common import arrow_pass, as_bytes, by_cell, cells, components, tree_edges
from lossloom.session import materialise, trimmed

SEED = 42
BITS = 64
LANE_WORDS = 64  # words of 64 lanes that are compared, and abandoned, together
SMALL_CELL = 64


def fingerprint(text: bytes, shingle: int = 4) -> int:
    """SimHash of a whole text as a signed 64-bit number; a text without words has 0."""
    found = text.lower().split()
    if not found:
        return 0
    if len(found) <= shingle:
        parts = [b" ".join(found)]
    else:
        parts = map(b" ".join, zip(*(found[k:] for k in range(shingle))))
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, parts, repeat(SEED)), "<u8")
    ones = np.zeros(BITS, np.int64)
    for start in range(0, len(hashes), 1 << 16):
        ones += np.unpackbits(hashes[start:start + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = 4) -> DataFrame:
    """(doc_id, fp long) for every row."""

    def make():
        def step(batch: dict) -> dict | None:
            if not batch:
                return None
            return {"doc_id": batch["doc_id"], "fp": [fingerprint(t, shingle) for t in batch["text"]]}

        return step

    return arrow_pass(docs.select(F.col("doc_id").cast("long"), as_bytes(F.col("text")).alias("text")), "doc_id long, fp long", make)


def near_lanes(plane: Callable[[int], np.ndarray], radius: int) -> np.ndarray | None:
    """Lanes (bits of words) whose distance is at most `radius`; `plane(b)` has a one where bit b differs.

    Three carry-save counter words hold the distances of all lanes at once and a fourth their overflow. As soon as
    every lane of the block is beyond the radius the rest of the planes is not read and None is returned.
    """
    first = plane(0)
    c0, c1, c2, over = first.copy(), np.zeros_like(first), np.zeros_like(first), np.zeros_like(first)

    def beyond() -> np.ndarray:
        gone, equal = over.copy(), ~over
        for k, c in ((2, c2), (1, c1), (0, c0)):
            if radius >> k & 1:
                equal &= c
            else:
                gone |= equal & c
                equal &= ~c
        return gone

    for b in range(1, BITS):
        carry = plane(b)
        for c in (c0, c1, c2):
            kept = c & carry
            c ^= carry
            carry = kept
        over |= carry
        if b > radius and b % 4 == 3 and not (~beyond()).any():
            return None
    return ~beyond()


def lanes_of(bits: np.ndarray) -> np.ndarray:
    """Pack 0/1 rows (BITS, lanes) into planes of 64-bit words; lanes beyond the end are ones (never near)."""
    missing = -bits.shape[1] % 64
    packed = np.packbits(np.pad(bits, ((0, 0), (0, missing))), axis=1, bitorder="little")
    return np.ascontiguousarray(packed).view("<u8")


def bits_of(values: np.ndarray) -> np.ndarray:
    """(BITS, n) array of 0/1 for n fingerprints."""
    return np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").T


def group_small(values: np.ndarray, cell: np.ndarray, size: np.ndarray, radius: int) -> Iterator[tuple[int, int]]:
    """Near pairs (positions) of rows sorted by cell, whose cells are small: lanes are pairs."""
    lefts, rights, held = [], [], 0
    top = int(size.max(initial=0))
    for gap in range(1, top):
        at = np.flatnonzero(cell[:-gap] == cell[gap:])
        lefts.append(at)
        rights.append(at + gap)
        held += len(at)
        if held > 1 << 18 or gap == top - 1:
            left, right = np.concatenate(lefts), np.concatenate(rights)
            lefts, rights, held = [], [], 0
            for s in range(0, len(left), 64 * LANE_WORDS):
                i, j = left[s:s + 64 * LANE_WORDS], right[s:s + 64 * LANE_WORDS]
                planes = lanes_of(bits_of(values[i] ^ values[j]))
                near = near_lanes(planes.__getitem__, radius)
                if near is not None:
                    hit = np.flatnonzero(np.unpackbits(near.view(np.uint8), bitorder="little")[:len(i)])
                    yield from zip(i[hit].tolist(), j[hit].tolist())


def group_large(values: np.ndarray, radius: int) -> np.ndarray:
    """Group label of each row of one large cell: rows are lanes, compared with 64 queries at a time."""
    n = len(values)
    planes = lanes_of(bits_of(values))
    label = np.arange(n)
    full = np.uint64(0xFFFFFFFFFFFFFFFF)
    for q in range(0, n, 64):
        own = bits_of(values[q:q + 64]).astype(bool)
        for w in range(q // 64, planes.shape[1], LANE_WORDS):
            block = planes[:, w:w + LANE_WORDS]
            near = near_lanes(lambda b: block[b][None, :] ^ np.where(own[b], full, np.uint64(0))[:, None], radius)
            if near is None:
                continue
            mask = np.unpackbits(near.view(np.uint8), axis=1, bitorder="little")[:, :n - 64 * w]
            for row in np.flatnonzero(mask.any(1)):
                seen = label[64 * w + np.flatnonzero(mask[row])]
                least = min(int(seen.min()), int(label[q + row]))
                if (seen != least).any() or label[q + row] != least:
                    label[np.isin(label, np.append(seen, label[q + row]))] = least
    return label


def union(pairs: Iterator[tuple[int, int]]) -> Iterator[list[int]]:
    """Groups of positions that pairs connect, each sorted."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i, j in pairs:
        a, b = root(i), root(j)
        if a != b:
            parent[max(a, b)] = min(a, b)
    groups: dict[int, list[int]] = {}
    for x in sorted(parent):
        groups.setdefault(root(x), []).append(x)
    yield from groups.values()


def cell_edges(values: np.ndarray, node: np.ndarray, cell: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Tree edges between nodes of whole cells; rows are sorted by cell."""
    start = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
    size = np.diff(np.r_[start, len(cell)])
    each = np.repeat(size, size)
    small = np.flatnonzero((each > 1) & (each < SMALL_CELL))
    found = [small[list(g)] for g in union(group_small(values[small], cell[small], each[small], radius))] if len(small) else []
    for s, n in zip(start[size >= SMALL_CELL], size[size >= SMALL_CELL]):
        label = group_large(values[s:s + n], radius)
        order = np.argsort(label, kind="stable")
        found += [s + g for g in np.split(order, np.flatnonzero(np.diff(label[order])) + 1) if len(g) > 1]
    out = []
    for group in found:
        out += tree_edges(sorted(set(node[group].tolist())))
    return out


def blocks_of(fp: Column, blocks: int, radius: int) -> Column:
    """Array of keys: fingerprints within the radius agree in at least one choice of `blocks - radius` blocks."""
    cut = [BITS * k // blocks for k in range(blocks + 1)]
    part = [F.shiftrightunsigned(fp, cut[k]).bitwiseAND(F.lit((1 << (cut[k + 1] - cut[k])) - 1)) for k in range(blocks)]
    return F.array(*(F.xxhash64(F.lit(n), *(part[k] for k in chosen))
                     for n, chosen in enumerate(combinations(range(blocks), blocks - radius))))


def link_edges(nodes: DataFrame, radius: int = 4, blocks: int = 6, block_rows: int = 2048) -> DataFrame:
    """Edges (a, b) that connect every pair of `nodes(fp, node)` at most `radius` bits apart, by way of others or directly."""
    spark = nodes.sparkSession
    keyed = materialise(nodes.select("node", "fp", F.explode(blocks_of(F.col("fp"), blocks, radius)).alias("key")))
    dealt = by_cell(cells(keyed, F.xxhash64("fp", F.lit(7)), block_rows), spark).select("cell", "key", "fp", "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            rows = pa.Table.from_batches(([rest] if rest is not None else []) + [batch]).combine_chunks()
            cell = rows["cell"].to_numpy()
            last = int(np.searchsorted(cell, cell[-1])) if len(cell) else 0
            whole, rest = rows.slice(0, last), rows.slice(last).combine_chunks()
            rest = rest.to_batches()[0] if rest.num_rows else None
            if whole.num_rows:
                yield out(whole)
        if rest is not None:
            yield out(pa.Table.from_batches([rest]))

    def out(rows: pa.Table) -> pa.RecordBatch:
        # A cell is a (cell, key) pair: rows whose cell hashes collide by chance stay apart.
        cell, key = rows["cell"].to_numpy(), rows["key"].to_numpy()
        group = np.cumsum(np.r_[True, (cell[1:] != cell[:-1]) | (key[1:] != key[:-1])])
        edges = cell_edges(rows["fp"].to_numpy().astype("<i8").view("<u8"), rows["node"].to_numpy(), group, radius)
        return pa.RecordBatch.from_pydict({"a": pa.array([e[0] for e in edges], pa.int64()), "b": pa.array([e[1] for e in edges], pa.int64())})

    return dealt.mapInArrow(run, "a long, b long")


@trimmed
def near_duplicates(docs: DataFrame, shingle: int = 4, radius: int = 4, blocks: int = 6, block_rows: int = 2048) -> DataFrame:
    """(doc_id, fp, component_id) for every row of `docs(doc_id, text)`.

    Rows with one fingerprint are folded first, so copies cost one row each and no pair. A null text has fingerprint
    zero and links like any other. Fingerprints are the nodes, so rows with a null id link others too; component_id is the smallest id
    of the component, null if all its ids are null. Repeated rows have one component, a very long text is hashed in bounded runs, an empty
    table gives no row. Other columns are ignored. `blocks` sets the width of the join keys (6: 21 of 64 bits);
    raise it with the corpus, every value of radius + 1 or more finds all links.
    """
    prints = materialise(fingerprints(docs, shingle))
    nodes = materialise(prints.groupBy("fp").agg(F.min("doc_id").alias("least")))
    found = components(link_edges(nodes.select("fp", F.col("fp").alias("node")), radius, blocks, block_rows))
    grouped = materialise(nodes.join(found, nodes["fp"] == found["node"], "left").select("fp", "least", F.coalesce("component", "fp").alias("group")))
    named = materialise(grouped.select("fp", "group").join(grouped.groupBy("group").agg(F.min("least").alias("component_id")), "group").select("fp", "component_id"))
    return prints.join(named, "fp").select("doc_id", "fp", "component_id")
