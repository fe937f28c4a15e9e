"""MinHash fingerprints of whole texts; near copies by bands of the signature joined in Spark and exact Jaccard."""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from hashlib import blake2b, sha256

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lossloom.llm.common import arrow_pass, as_bytes, components, slices
from lossloom.llm.infill import byte_of, count_units
from lossloom.operators.ordering import running_totals
from lossloom.session import materialise

SHINGLE = 5
PERMUTATIONS = 128
# 1 - (1 - 0.8^4)^12 = 0.998 of the pairs with Jaccard 0.8 collide in a band, and more of the closer ones.
BANDS, BAND_ROWS = 12, 4
SKETCH = 64
# A pair with Jaccard 0.8 agrees in fewer than 35 of 64 minima with a probability under 1e-6.
SKETCH_LEAST = 35
PIECE = 256
TEXT_OVERHEAD = 64

_RANDOM = np.random.default_rng(12)
COEFFICIENTS = _RANDOM.integers(1, 1 << 63, SHINGLE, np.uint64) * np.uint64(2) + np.uint64(1)
MULTIPLIERS = _RANDOM.integers(1, 1 << 63, PERMUTATIONS, np.uint64) * np.uint64(2) + np.uint64(1)
ADDENDS = _RANDOM.integers(0, 1 << 63, PERMUTATIONS, np.uint64)


def shingle_hashes(text: bytes) -> np.ndarray:
    """64-bit hash of every five-word shingle (of the whole, if shorter) of the words in lower case (A to Z)."""
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    own = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    width = min(SHINGLE, len(words))
    total = own[:len(own) - width + 1] * COEFFICIENTS[0]
    for j in range(1, width):
        total = total + own[j:len(own) - width + 1 + j] * COEFFICIENTS[j]
    total ^= total >> np.uint64(29)
    total *= COEFFICIENTS[1]
    return total ^ (total >> np.uint64(32))


def minima(hashes: np.ndarray, count: int = PERMUTATIONS) -> np.ndarray:
    """Smallest value of each universal hash (a x + b mod 2^64, x 32 bits, upper 32 bits kept); all ones without a shingle."""
    least = np.full(count, np.iinfo(np.uint64).max, np.uint64)
    low = hashes & np.uint64(0xFFFFFFFF)
    for start in range(0, len(low), PIECE):
        mixed = low[start:start + PIECE, None] * MULTIPLIERS[:count]
        mixed += ADDENDS[:count]
        np.minimum(least, mixed.min(0), out=least)
    return (least >> np.uint64(32)).astype(np.uint32)


def fingerprint(least: np.ndarray) -> str:
    """The lower 16 bits of every minimum, four hex digits each."""
    return least.astype(">u2").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of equal components of two fingerprints: the estimate of the Jaccard similarity."""
    return float(np.mean(a.astype(np.uint16) == b.astype(np.uint16)))


def with_text_hash(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), as_bytes(F.col("text")).alias("text")).withColumn("text_hash", F.xxhash64("text"))


def sketches(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, n_bytes, digest, sketch, bands) of every row: a word digest, 64 bytes of minima, one key a band."""

    def make():
        def step(batch: dict) -> dict | None:
            if not batch:
                return None
            out: dict[str, list] = {c: [] for c in ("digest", "sketch", "bands")}
            for text in batch["text"]:
                least = minima(shingle_hashes(text), SKETCH)
                out["digest"].append(int.from_bytes(blake2b(b" ".join(text.lower().split()), digest_size=8).digest(), "little", signed=True))
                out["sketch"].append(least.astype(np.uint8).tobytes())
                keys = least[:BANDS * BAND_ROWS].reshape(BANDS, BAND_ROWS)
                out["bands"].append([xxhash.xxh64_intdigest(keys[b].tobytes(), b) - (1 << 63) for b in range(BANDS)])
            return {"doc_id": batch["doc_id"], "text_hash": batch["text_hash"], "n_bytes": [len(t) for t in batch["text"]], **out}

        return step

    return arrow_pass(with_text_hash(docs), "doc_id long, text_hash long, n_bytes long, digest long, sketch binary, bands array<long>", make)


def close_sketches(a: bytes, b: bytes) -> bool:
    return int(np.count_nonzero(np.frombuffer(a, np.uint8) == np.frombuffer(b, np.uint8))) >= SKETCH_LEAST


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Exact similarity of two sorted arrays of distinct shingle hashes."""
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common / (len(a) + len(b) - common) if len(a) or len(b) else 1.0


def by_cell(rows: DataFrame, *columns: str) -> DataFrame:
    """Rows of a cell next to each other in one task, held rows first."""
    width = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.select("cell", F.col("held").cast("int").alias("held"), "node", "component", *columns).repartition(
        width, "cell").sortWithinPartitions("cell", F.desc("held"), "node")


def near_rows(rows: DataFrame) -> DataFrame:
    """(cell, held, node, component) of the `rows(cell, held, node, component, sketch)` that have a close sketch of another component in their cell.

    Held rows are compared with all of their cell, as in verified(); every row is given once, so texts are fetched for few rows of a cell.
    """
    schema = pa.schema([("cell", pa.int64()), ("held", pa.int32()), ("node", pa.int64()), ("component", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = None
        kept: list[tuple] = []
        seen = np.empty((0, SKETCH), np.uint8)
        parts = np.empty(0, np.int64)
        given = np.empty(0, bool)
        for batch in batches:
            out: list[tuple] = []
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                cell, held, node, component, sketch = row
                if cell != now:
                    now, kept, given, count = cell, [], np.zeros(64, bool), 0
                    seen, parts = np.empty((64, SKETCH), np.uint8), np.empty(64, np.int64)
                own = np.frombuffer(sketch, np.uint8)
                close = ((seen[:count] == own).sum(1) >= SKETCH_LEAST) & (parts[:count] != component)
                hit = bool(close.any())
                for k in np.flatnonzero(close & ~given[:count]).tolist():
                    out.append(kept[k])
                    given[k] = True
                if hit:
                    out.append(row[:4])
                if held:
                    if count == len(given):
                        seen, parts, given = np.concatenate([seen, seen]), np.concatenate([parts, parts]), np.concatenate([given, given])
                    seen[count], parts[count], given[count] = own, component, hit
                    kept.append(row[:4])
                    count += 1
            yield pa.RecordBatch.from_pydict(dict(zip(schema.names, zip(*out))) if out else {c: [] for c in schema.names}, schema=schema)

    return by_cell(rows, "sketch").mapInArrow(run, "cell long, held int, node long, component long")


def verified(rows: DataFrame, threshold: float) -> DataFrame:
    """Edges (a, b) of `rows(cell, held, node, component, sketch, text)`: rows that are held are compared with all of their cell.

    A cell's held rows come first and stay as shingle sets; the others pass by one at a time. Pairs whose sketches are too far apart for
    the threshold, and pairs whose components hang together already, from before or by edges of the cell, are not compared. So a cell gives
    fewer edges than it has components.
    """
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress

        def shingles_of(data: bytes) -> np.ndarray:
            return np.unique(shingle_hashes(unpack(data) if data else b""))

        now, kept = None, []
        above: dict[int, int] = {}

        def root(x: int) -> int:
            while above.setdefault(x, x) != x:
                above[x] = above[above[x]]
                x = above[x]
            return x

        for whole in batches:
            for batch in slices(whole, 2_000_000):
                left, right = [], []
                for cell, held, node, component, sketch, text in zip(*(c.to_pylist() for c in batch.columns)):
                    if cell != now:
                        now, kept = cell, []
                        above.clear()
                    own = None
                    for k, (other, other_component, other_sketch, shingles) in enumerate(kept):
                        if root(other_component) == root(component) or not close_sketches(sketch, other_sketch):
                            continue
                        own = shingles_of(text) if own is None else own
                        if isinstance(shingles, bytes):
                            shingles = shingles_of(shingles)
                            kept[k] = (other, other_component, other_sketch, shingles)
                        if jaccard(own, shingles) >= threshold:
                            left.append(node)
                            right.append(other)
                            above[root(component)] = root(other_component)
                    if held:
                        kept.append((node, component, sketch, text if own is None else own))
                yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], schema=schema)

    return by_cell(rows, "sketch", "text").mapInArrow(run, "a long, b long")


def texts_of(nodes: DataFrame, found: DataFrame, docs: DataFrame) -> DataFrame:
    """(node, sketch, text) of the given nodes, texts compressed: one each, by the id and hash of the least row that has it."""
    rows = found.join(nodes, found["digest"] == nodes["node"], "left_semi").groupBy("digest", "doc_id", "text_hash").agg(
        F.first("sketch").alias("sketch"), F.count(F.lit(1)).alias("n"))
    least = rows.groupBy("digest").agg(F.min_by(F.struct("text_hash", "doc_id", "sketch", "n"), F.struct("text_hash", "doc_id")).alias("row"))
    wanted = materialise(least.select(F.col("digest").alias("node"), F.col("row.doc_id").alias("id"), F.col("row.text_hash").alias("hash"),
                                      "row.sketch", "row.n"))
    docs = with_text_hash(docs)
    met = docs.join(wanted, docs["doc_id"].eqNullSafe(wanted["id"]) & (docs["text_hash"] == wanted["hash"])).select("node", "sketch", "n", "text")

    def make():
        pack = zstandard.ZstdCompressor(level=1).compress

        def step(batch: dict) -> dict | None:
            return {**batch, "text": [pack(t) for t in batch["text"]]} if batch else None

        return step

    packed = materialise(arrow_pass(met, "node long, sketch binary, n long, text binary", make))
    single, repeated = packed.filter("n = 1").drop("n"), packed.filter("n > 1")
    return single.unionByName(repeated.groupBy("node").agg(F.first("sketch").alias("sketch"), F.min("text").alias("text")))


def copies(docs: DataFrame, found: DataFrame, threshold: float = 0.8, block_rows: int = 256) -> DataFrame:
    """(digest, component): for every text that is linked to another of different words, the smallest digest of its class.

    `found` is a written table of sketches(docs). First a text is compared with the smallest digest that it shares a bucket with, one pair a text
    however many buckets it has. Buckets that still hold two components are then compared in full:
    rows outside the leader's component, in blocks of `block_rows`, meet each other and the rows inside it. So a large group of near
    copies costs one pass, and no link between texts that share a band is lost.
    """
    keyed = found.select(F.col("digest").alias("node"), F.explode("bands").alias("key"))
    buckets = materialise(keyed.groupBy("key").agg(F.min("node").alias("leader"), F.max("node").alias("last"))
                          .filter("leader <> last").select("key", "leader"))
    members = materialise(keyed.join(buckets, "key").select("key", "node", "leader").distinct())
    texts = texts_of(members.select("node").distinct(), found, docs)

    pairs = members.groupBy("node").agg(F.min("leader").alias("leader")).filter("node <> leader")
    sizes = pairs.groupBy("leader").agg(F.ceil(F.count(F.lit(1)) / F.lit(4 * block_rows)).cast("int").alias("blocks"))
    sizes = materialise(sizes)
    cell = F.xxhash64("leader", "block")
    followers = pairs.join(sizes, "leader").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    leaders = sizes.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumn("node", F.col("leader"))
    rows = leaders.select(cell.alias("cell"), F.lit(True).alias("held"), "node").unionByName(
        followers.select(cell.alias("cell"), F.lit(False).alias("held"), "node"))
    sketched = texts.select("node", "sketch")
    near = materialise(near_rows(rows.join(sketched, "node").withColumn("component", F.col("node"))))
    first = materialise(verified(near.join(texts, "node"), threshold))
    labels = components(first)

    named = members.join(labels.withColumnRenamed("node", "labelled"), F.col("node") == F.col("labelled"), "left").select(
        "key", "node", "leader", F.coalesce("component", "node").alias("component"))
    named = materialise(named)
    mixed = named.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"),
                                     F.max(F.when(F.col("node") == F.col("leader"), F.col("component"))).alias("main")).filter("low <> high")
    split = named.join(mixed.select("key", "main"), "key").withColumn("minor", F.col("component") != F.col("main"))
    split = materialise(split.select("key", "node", "component", "minor"))
    counts = materialise(split.groupBy("key").agg(F.ceil(F.count_if("minor") / F.lit(block_rows)).cast("int").alias("u"),
                                                  F.ceil(F.count_if(~F.col("minor")) / F.lit(block_rows)).cast("int").alias("v")))
    dealt = split.join(counts, "key").withColumn("own", F.pmod(F.xxhash64("node", F.lit(5)), F.when(F.col("minor"), F.col("u")).otherwise(F.col("v"))).cast("int"))
    # A minor block i is held in the cells (i, j) with the other blocks j <= i of minors (j < 0: with the main block -1 - j).
    held = dealt.filter("minor").select("node", "component", F.explode(F.transform(
        F.sequence(-F.col("v"), F.col("own")), lambda j: F.xxhash64("key", "own", j))).alias("cell"), F.lit(True).alias("held"))
    others = dealt.filter("minor").withColumn("i", F.explode(F.sequence(F.col("own"), F.col("u") - 1))).filter("i <> own").select(
        "node", "component", F.xxhash64("key", "i", F.col("own")).alias("cell"), F.lit(False).alias("held"))
    mains = dealt.filter(~F.col("minor")).withColumn("i", F.explode(F.sequence(F.lit(0), F.col("u") - 1))).select(
        "node", "component", F.xxhash64("key", "i", -1 - F.col("own")).alias("cell"), F.lit(False).alias("held"))
    near = materialise(near_rows(held.unionByName(others).unionByName(mains).join(sketched, "node")))
    rest = materialise(verified(near.join(texts, "node"), threshold))
    return components(first.unionByName(rest)).withColumnRenamed("node", "digest")


def classes(docs: DataFrame, found: DataFrame, threshold: float = 0.8) -> DataFrame:
    """(doc_id, text_hash, component_id, class_rows) of the rows whose class has two rows or more; component_id is the smallest id in it."""
    linked = copies(docs, found, threshold)
    rows = found.select("doc_id", "text_hash", "digest").join(linked, "digest", "left").select(
        "doc_id", "text_hash", F.coalesce("component", "digest").alias("class"))
    groups = materialise(rows.groupBy("class").agg(F.min("doc_id").alias("component_id"), F.count(F.lit(1)).alias("class_rows")).filter("class_rows > 1"))
    return rows.join(groups, "class").groupBy("doc_id", "text_hash").agg(
        F.min("component_id").alias("component_id"), F.max("class_rows").alias("class_rows"))


def part_starts(found: DataFrame, parts: int) -> list[tuple]:
    """First key of each part of the order (descending id, null last, then hash), parts holding about equal bytes; at most `parts` rows.

    A stretch of equal rows that is larger than a part is the first of several parts.
    """
    runs = found.groupBy("doc_id", "text_hash").agg(F.sum(F.col("n_bytes") + TEXT_OVERHEAD).alias("size"))
    order = [F.desc_nulls_last("doc_id"), F.col("text_hash")]
    placed = materialise(running_totals(runs, order, {"upto": F.col("size")}).withColumn("from", F.col("upto") - F.col("size")))
    total = placed.agg(F.max("upto")).first()[0]
    if total is None:
        return []
    step = max(1, -(-total // parts))
    first, last = F.floor((F.col("from") + step - 1) / step), F.floor((F.col("upto") - 1) / step)
    starts = placed.filter(first <= last).withColumn("part", F.explode(F.sequence(first, last)))
    return [order_key(r["doc_id"], r["text_hash"]) for r in starts.select("part", "doc_id", "text_hash").orderBy("part").collect()]


def order_key(doc_id: int | None, text_hash: int) -> tuple:
    return (1, 0, text_hash) if doc_id is None else (0, -doc_id, text_hash)


DEALT = "part int, follows boolean, doc_id long, text_hash long, data binary, component_id long, class_rows long"


def dealt_rows(docs: DataFrame, starts: list[tuple]) -> DataFrame:
    """Rows with their part, texts compressed; the first row of a part also follows the part before (the first of all the last)."""
    parts = len(starts)

    def make():
        pack = zstandard.ZstdCompressor(level=1).compress
        spread: dict[tuple, int] = {}

        def step(batch: dict) -> dict | None:
            if not batch:
                return None
            rows: list[tuple] = []
            for doc_id, text, text_hash in zip(batch["doc_id"], batch["text"], batch["text_hash"]):
                key = order_key(doc_id, text_hash)
                low, high = bisect_left(starts, key), bisect_right(starts, key)
                data = pack(text)
                part = high - 1
                if high > low:
                    seen = spread.get(key, 0)
                    spread[key] = seen + 1
                    # The first of equal rows of a task goes to the last part, so that one surely meets the next text.
                    part -= seen % (high - low)
                    if not seen:
                        rows += [((p - 1) % parts, True, doc_id, text_hash, data) for p in range(low, high)]
                rows.append((part, False, doc_id, text_hash, data))
            return dict(zip(("part", "follows", "doc_id", "text_hash", "data"), zip(*rows)))

        return step

    dealt = arrow_pass(with_text_hash(docs), DEALT.rsplit(", ", 2)[0], make)
    return dealt.select("*", F.lit(None).cast("long").alias("component_id"), F.lit(None).cast("long").alias("class_rows"))


def dealt_classes(groups: DataFrame, starts: list[tuple]) -> DataFrame:
    """Rows of classes() for every part that may hold their texts, so that texts and classes meet by one order and no join."""

    def make():
        def step(batch: dict) -> dict | None:
            if not batch:
                return None
            rows: list[tuple] = []
            for doc_id, text_hash, component, size in zip(*(batch[c] for c in ("doc_id", "text_hash", "component_id", "class_rows"))):
                key = order_key(doc_id, text_hash)
                low, high = bisect_left(starts, key), bisect_right(starts, key)
                rows += [(p, False, doc_id, text_hash, None, component, size) for p in range(min(low, high - 1), high)]
            return dict(zip(("part", "follows", "doc_id", "text_hash", "data", "component_id", "class_rows"), zip(*rows)))

        return step

    return arrow_pass(groups.select("doc_id", "text_hash", "component_id", "class_rows"), DEALT, make)


def edited_text(text: bytes, n: int, following: bytes, following_n: int) -> bytes:
    """The text with its last n // 2 code points replaced by the first as many of the following text."""
    half = n // 2
    return text[:byte_of(text, n - half)] + following[:byte_of(following, min(half, following_n))]


RESULT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, "
          "component_id long, class_rows long")


def fingerprinted(dealt: DataFrame, parts: int) -> DataFrame:
    """Fingerprints of every row of a part, of its edited text, and their likeness; one row and the one after it are held at a time."""
    target = dealt.sparkSession.createDataFrame([], RESULT).schema
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(target)
    # A class row has no data and so comes just before the texts that it belongs to.
    order = ["part", "follows", F.desc_nulls_last("doc_id"), "text_hash", F.asc_nulls_first("data")]
    ordered = dealt.repartition(parts, "part").sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        held = group = None
        for whole in batches:
            for batch in slices(whole, 2_000_000):
                out: list[tuple] = []
                for part, follows, doc_id, text_hash, data, component, size in zip(*(c.to_pylist() for c in batch.columns)):
                    if data is None:
                        group = (doc_id, text_hash, component, size)
                        continue
                    if follows and held is None:
                        continue
                    text = unpack(data)
                    least, n = minima(shingle_hashes(text)), count_units(text)
                    if held is not None:
                        own_id, own, own_n, own_least, own_group = held
                        edited = edited_text(own, own_n, text, n)
                        new = minima(shingle_hashes(edited))
                        out.append((own_id, own_n, sha256(edited).hexdigest(), fingerprint(own_least), fingerprint(new),
                                    likeness(own_least, new), likeness(own_least, least), *own_group))
                    mine = group[2:] if group is not None and group[:2] == (doc_id, text_hash) else (doc_id, 1)
                    held = None if follows else (doc_id, text, n, least, mine)
                if out:
                    yield pa.RecordBatch.from_pydict(dict(zip(arrow.names, zip(*out))), schema=arrow)

    return ordered.mapInArrow(run, target)


def fingerprint_documents(docs: DataFrame, threshold: float = 0.8) -> DataFrame:
    """One row for each row of `docs(doc_id, text)`: fingerprints of its text and of its edited text, and its class of near copies.

    The text after a text is that of the next smaller doc_id; null ids come last, rows of one id in the order of xxhash64 of their texts, and
    repeated rows follow each other; the last row is followed by the first, a single row by itself. A null text is empty; texts without a
    word share one fingerprint (all ones) and one class. A very long text is held alone with the one after it. component_id is the smallest
    id of the rows linked by exact Jaccard `threshold` or more of five-word shingles (a null if all are null), class_rows their number;
    a row alone has its own id and 1. Other columns are not read; an empty table gives no row.
    """
    spark = docs.sparkSession
    found = materialise(sketches(docs))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), docs.rdd.getNumPartitions())
    starts = part_starts(found, parts)
    if not starts:
        return spark.createDataFrame([], RESULT)
    groups = materialise(classes(docs, found, threshold))
    return fingerprinted(dealt_rows(docs, starts).unionByName(dealt_classes(groups, starts)), parts)
