"""Language-model scores of whole texts: a causal attention model over subword ids, beside a smoothed count of words."""

from __future__ import annotations

import pickle
from collections import Counter
from itertools import compress

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lossloom.llm import attention
from lossloom.llm.attention import BEGIN, HALF
from lossloom.llm.common import arrow_pass, as_bytes, fold
from lossloom.llm.packing import word_encoder
from lossloom.session import materialise

END_WORD = b"\n"  # no word holds a line feed
FLUSH = 200_000
HEAD = 100_000
INPUTS, CLASSES, SINGLE = 1024, 64, 48
FREQUENT = 2048  # ids whose counts after each symbol are looked up in a dense table, those of the others by search
ALPHA = 2.0
PIECE = 512  # ids of a training text that are dealt to a task together, a multiple of HALF
CONTEXT = HALF + 1  # ids before a later piece that its first windows see
WORKERS, ROUNDS = 12, 3
WORKER_IDS = 4_000_000  # ids that one task learns from in a round, until there are MOST_WORKERS tasks
MOST_WORKERS = 256
WARM_PIECES = 1000
LEARN_IDS = 1 << 19  # ids whose windows are held and shuffled together


def count_words(docs: DataFrame) -> DataFrame:
    """(word binary, n) over whole texts `docs(text binary)`, one end a text; tasks add up before anything is shuffled."""

    def make():
        counts: Counter = Counter()

        def give() -> dict:
            out = {"word": list(counts), "n": list(counts.values())}
            counts.clear()
            return out

        def step(batch: dict) -> dict | None:
            for text in batch.get("text", ()):
                counts.update(text.lower().split())
                counts[END_WORD] += 1
            return give() if not batch or len(counts) > FLUSH else None

        return step

    return arrow_pass(docs.select("text"), "word binary, n long", make).groupBy("word").agg(F.sum("n").alias("n"))


def head_counts(counts: DataFrame, most: int = HEAD) -> dict[bytes, int]:
    """The most frequent words, at most `most` of them: those above a count that a histogram of counts gives."""
    level = F.floor(8 * F.log2(F.col("n").cast("double"))).cast("int")
    sizes = {r["level"]: r["words"] for r in counts.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("words")).collect()}
    total, lowest = 0, None
    for k in sorted(sizes, reverse=True):
        total += sizes[k]
        if total > most:
            break
        lowest = k
    return {} if lowest is None else {bytes(r["word"]): r["n"] for r in counts.filter(level >= lowest).toLocalIterator()}


class Symbols:
    """Maps subword ids to input symbols and output classes, and holds what is known of an id from the one before it.

    The most frequent ids are symbols and classes of their own; the rest share classes of about equal counts. Inside its class
    an id has the share of its count after the symbol before it, smoothed with its share of the class; a symbol before
    it is one inside the same word, else BEGIN. Probabilities of all ids sum to one after every symbol.
    """

    def __init__(self, counts: np.ndarray, ends: np.ndarray):
        order = np.argsort(-counts, kind="stable")
        self.of_class = np.empty(len(counts), np.int16)
        self.of_class[order[:SINGLE]] = np.arange(SINGLE)
        smooth = counts + 0.5
        tail = np.cumsum(smooth[order[SINGLE:]])
        self.of_class[order[SINGLE:]] = SINGLE + np.minimum((tail / tail[-1] * (CLASSES - SINGLE)).astype(int), CLASSES - SINGLE - 1)
        mass = np.bincount(self.of_class, smooth, CLASSES)
        self.share = smooth / mass[self.of_class]
        self.mass = np.maximum(mass, 1e-3) / np.maximum(mass, 1e-3).sum()
        self.rank = np.empty(len(counts), np.int32)
        self.rank[order] = np.arange(len(counts))
        own = INPUTS - 2 - 24
        self.symbol = np.where(self.rank < own, self.rank, own + np.minimum(
            (np.log2(self.rank - np.minimum(self.rank, own) + 1) * 1.5).astype(int), 23)).astype(np.int32) + 2
        self.before = np.where(ends, BEGIN, self.symbol).astype(np.int32)
        self.frequent = order[:FREQUENT]
        self.follow(np.zeros(0, np.int64), np.zeros(0, np.int64))

    def follow(self, cells: np.ndarray, n: np.ndarray) -> None:
        """Take in how often ids come after symbols: counts `n` of distinct cells symbol * (number of ids) + id."""
        size = len(self.of_class)
        before, target = cells // size, cells % size
        by_class = np.zeros((INPUTS, CLASSES))
        np.add.at(by_class, (before, self.of_class[target]), n)
        rank = self.rank[target]
        often = rank < FREQUENT
        pairs = np.zeros((INPUTS, len(self.frequent)))
        pairs[before[often], rank[often]] = n[often]
        kind = self.of_class[self.frequent]
        self.inside = np.log((pairs + ALPHA * self.share[self.frequent]) / (by_class[:, kind] + ALPHA)).astype(np.float32)
        before, target, n = before[~often], target[~often], n[~often]
        order = np.argsort(cells[~often])
        self.rare = cells[~often][order].astype(np.int32)
        found = np.log((n + ALPHA * self.share[target]) / (by_class[before, self.of_class[target]] + ALPHA))
        self.rare_inside = found[order].astype(np.float32)
        self.unseen = np.log(ALPHA / (by_class + ALPHA)).astype(np.float32)
        after = (by_class + ALPHA * self.mass) / (by_class.sum(1, keepdims=True) + ALPHA)
        self.prior = (1 + np.log(after) / 16).astype(np.float32)

    def inside_class(self, before: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Natural log probability of ids inside their class after symbols."""
        rank = self.rank[target]
        out = self.inside[before, np.minimum(rank, len(self.frequent) - 1)]
        rare = rank >= FREQUENT
        if rare.any():
            left, right = before[rare], target[rare]
            value = self.unseen[left, self.of_class[right]] + np.log(self.share[right])
            if len(self.rare):
                cell = left.astype(np.int32) * np.int32(len(self.of_class)) + right.astype(np.int32)
                at = np.minimum(np.searchsorted(self.rare, cell), len(self.rare) - 1)
                value = np.where(self.rare[at] == cell, self.rare_inside[at], value)
            out[rare] = value
        return out


class TextScorer:
    """Ids of texts as model input, and their scores."""

    def __init__(self, vocabulary: str, symbols: Symbols | None = None, model: dict | None = None):
        self.encoder = word_encoder(vocabulary)
        self.size = self.encoder.model.get_vocab_size()
        self.end = self.size - 1
        tokens = sorted(self.encoder.model.get_vocab().items(), key=lambda t: t[1])
        self.ends = np.array([t.endswith("</w>") for t, _ in tokens])
        self.symbols, self.model = symbols, model

    def packed(self, texts: list[bytes]) -> list[bytes]:
        """Ids of texts and their ends as 16-bit numbers."""
        end = np.array([self.end], "<u2").tobytes()
        return [e + end for e in self.encoder.encode(texts)]

    def ids(self, texts: list[bytes]) -> list[np.ndarray]:
        return [np.frombuffer(e, "<u2").astype(np.int32) for e in self.packed(texts)]

    def examples(self, ids: list[np.ndarray]) -> tuple[np.ndarray, ...]:
        """Windows, symbols before, target ids and weights (0 beyond a text's end) of their positions, and windows by text."""
        x, counts = attention.windows([np.r_[BEGIN, self.symbols.symbol[i[:-1]]] for i in ids])
        before, target = np.full((len(x), HALF), BEGIN, np.int32), np.zeros((len(x), HALF), np.int32)
        weight = np.zeros((len(x), HALF), np.float32)
        places, flat, flags = before.reshape(-1), target.reshape(-1), weight.reshape(-1)
        begin = np.concatenate([[0], np.cumsum(counts)[:-1]]) * HALF
        for at, i in zip(begin, ids):
            places[at + 1:at + len(i)] = self.symbols.before[i[:-1]]
            flat[at:at + len(i)] = i
            flags[at:at + len(i)] = 1
        return x, before, target, weight, counts

    def lessons(self, pieces: list[np.ndarray], inner: list[bool]) -> tuple[np.ndarray, ...]:
        """examples() of pieces of texts; an inner piece begins with CONTEXT ids that are seen and not learned."""
        first, later = ([p for p, k in zip(pieces, inner) if k == kind] for kind in (False, True))
        parts = [self.examples(first)[:-1]] if first else []
        if later:
            # The id before a context's own HALF symbols takes the place of BEGIN, and the context's window is left out.
            x, before, target, weight, counts = self.examples([p[1:] for p in later])
            begin = np.cumsum(counts) - counts
            x[begin, HALF] = [self.symbols.symbol[p[0]] for p in later]
            x[begin + 1, 0] = x[begin, HALF]
            keep = np.ones(len(x), bool)
            keep[begin] = False
            parts.append((x[keep], before[keep], target[keep], weight[keep]))
        return tuple(np.concatenate(column) for column in zip(*parts))

    def learn(self, adam: attention.Adam, pieces: list[np.ndarray], inner: list[bool], passes: int = 1) -> int:
        """Adam steps over all windows of pieces of texts, in an order that depends on their number alone."""
        x, before, target, weight = self.lessons(pieces, inner)
        kind = self.symbols.of_class[target]
        order = np.random.default_rng(len(x)).permutation(len(x))
        for _ in range(passes):
            for s in range(0, len(x), 256):
                part = order[s:s + 256]
                prior = self.symbols.prior.take(before.take(part, 0).reshape(-1), 0)
                adam.update(attention.gradient(adam.model, x.take(part, 0), prior, kind.take(part, 0), weight.take(part, 0))[1])
        return len(x)

    def scores(self, found: list[np.ndarray]) -> list[float]:
        """log10 probability of each whole text and its end, from its ids."""
        out: list[float] = []
        at = 0
        while at < len(found):
            stop, total = at, 0
            while stop < len(found) and (stop == at or total + len(found[stop]) <= 200_000):
                total += len(found[stop])
                stop += 1
            x, before, target, weight, counts = self.examples(found[at:stop])
            logp = attention.class_scores(self.model, x, self.symbols.prior, before, self.symbols.of_class[target])
            logp += self.symbols.inside_class(before, target)
            per_window = (logp * weight).sum(1, dtype=np.float64)
            out += (np.add.reduceat(per_window, np.cumsum(counts) - counts) / np.log(10)).tolist()
            at = stop
        return out


def word_ends(spark: SparkSession, vocabulary: str) -> np.ndarray:
    """Which ids end a word; read in a task, so that the driver loads no tokenizer."""

    def make():
        return lambda batch: {"ends": [TextScorer(vocabulary).ends.tobytes()]} if batch else None

    return np.frombuffer(arrow_pass(spark.range(1), "ends binary", make).first()["ends"], bool)


def id_counts(counts: DataFrame, vocabulary: str) -> Symbols:
    """Symbols from the counts of ids, and of all ids after symbols, over all training texts, by way of the counts of their words.

    The pairs that occur reach the driver: their number grows with the corpus, up to INPUTS times the ids of the vocabulary.
    """

    def make_ids():
        scorer = TextScorer(vocabulary)
        end = np.array([scorer.end], "<u2").tobytes()

        def step(batch: dict) -> dict | None:
            if not batch:
                return None
            ids = [e if w != END_WORD else end for w, e in zip(batch["word"], scorer.encoder.encode(batch["word"]))]
            return {"ids": ids, "n": batch["n"]}

        return step

    encoded = materialise(arrow_pass(counts, "ids binary, n long", make_ids))

    def tally(key) -> tuple[np.ndarray, np.ndarray]:
        def make():
            held: list[tuple[np.ndarray, np.ndarray]] = []

            def fold_held() -> tuple[np.ndarray, np.ndarray]:
                cell, at = np.unique(np.concatenate([c for c, _ in held]), return_inverse=True)
                total = np.zeros(len(cell), np.int64)
                np.add.at(total, at, np.concatenate([n for _, n in held]))
                return cell, total

            def step(batch: dict) -> dict | None:
                if batch:
                    sizes = np.array([len(i) // 2 for i in batch["ids"]])
                    first = np.zeros(int(sizes.sum()), bool)
                    first[(np.cumsum(sizes) - sizes)[sizes > 0]] = True
                    held.append((key(np.frombuffer(b"".join(batch["ids"]), "<u2").astype(np.int64), first), np.repeat(np.array(batch["n"], np.int64), sizes)))
                    if sum(len(c) for c, _ in held) > 2 * len(held[0][0]) + FLUSH:
                        held[:] = [fold_held()]
                    return None
                if not held:
                    return None
                cell, total = fold_held()
                return {"cell": cell.tolist(), "n": total.tolist()}

            return step

        # At most one row for each cell of a table of fixed size.
        found = arrow_pass(encoded, "cell int, n long", make).groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
        return found["cell"].to_numpy().astype(np.int64), found["n"].to_numpy()

    ends = word_ends(counts.sparkSession, vocabulary)
    single = np.zeros(len(ends), np.int64)
    cell, n = tally(lambda ids, first: ids)
    single[cell] = n
    symbols = Symbols(single, ends)
    symbol, size = symbols.before, len(ends)

    def pair(ids: np.ndarray, first: np.ndarray) -> np.ndarray:
        return np.where(first, BEGIN, symbol[np.r_[0, ids[:-1]]]).astype(np.int64) * size + ids

    symbols.follow(*tally(pair))
    return symbols


def text_pieces(texts: DataFrame, vocabulary: str) -> DataFrame:
    """id_pieces() of `texts(draw, text)`: all ids of every text and its end."""

    def make():
        scorer = TextScorer(vocabulary)
        return lambda batch: {"draw": batch["draw"], "ids": scorer.packed(batch["text"])} if batch else None

    return id_pieces(arrow_pass(texts.select("draw", F.col("text").cast("binary").alias("text")), "draw long, ids binary", make))


def id_pieces(texts: DataFrame) -> DataFrame:
    """(draw, place, ids binary) of `texts(draw, ids)`, 16-bit numbers: all ids of every text, PIECE at a time.

    Pieces after the first (place 0) begin with the CONTEXT ids before them, so the windows of all pieces are those of the
    whole text.
    """

    def make():
        def step(batch: dict) -> dict | None:
            if not batch:
                return None
            out: dict[str, list] = {"draw": [], "place": [], "ids": []}
            for draw, ids in zip(batch["draw"], batch["ids"]):
                for at in range(0, len(ids) // 2, PIECE):
                    out["draw"].append(draw)
                    out["place"].append(at // PIECE)
                    out["ids"].append(ids[2 * max(0, at - CONTEXT):2 * (at + PIECE)])
            return out

        return step

    return arrow_pass(texts.select("draw", "ids"), "draw long, place int, ids binary", make)


def train(texts: DataFrame, vocabulary: str, symbols: Symbols) -> dict[str, np.ndarray]:
    """Attention model from all windows of all training texts `texts(draw, ids)`.

    A bounded sample gives the start; then tasks share the pieces of all texts for ROUNDS rounds, each round a share of them, and
    the mean of their models, weighted by windows, begins the next round. What reaches the driver is one model a task.
    """
    pieces = materialise(id_pieces(texts))
    spark = texts.sparkSession
    total = pieces.agg(F.sum(F.octet_length("ids") / 2)).first()[0] or 0
    workers = int(min(max(WORKERS, -(-total // (ROUNDS * WORKER_IDS))), MOST_WORKERS))

    def learner(shared, rate: float, passes: int):
        def make():
            symbols, own = pickle.loads(shared.value)
            scorer = TextScorer(vocabulary, symbols)
            adam = attention.Adam(own, rate)
            seen, size = [0], [0]
            held: list[tuple[np.ndarray, bool]] = []

            def flush() -> None:
                seen[0] += scorer.learn(adam, *map(list, zip(*held)), passes)
                held.clear()
                size[0] = 0

            def step(batch: dict) -> dict | None:
                for place, ids in zip(batch.get("place", ()), batch.get("ids", ())):
                    held.append((np.frombuffer(ids, "<u2").astype(np.int32), place > 0))
                    size[0] += len(held[-1][0])
                    if size[0] >= LEARN_IDS:
                        flush()
                if held and not batch:
                    flush()
                return None if batch else {"model": [pickle.dumps(own)], "n": [seen[0]]}

            return step

        return make

    def trained(part: DataFrame, model: dict, rate: float, passes: int) -> dict:
        shared = spark.sparkContext.broadcast(pickle.dumps((symbols, model)))
        rows = arrow_pass(part.select("place", "ids"), "model binary, n long", learner(shared, rate, passes)).filter("n > 0").collect()
        shared.unpersist()
        models = [(pickle.loads(row["model"]), row["n"]) for row in sorted(rows, key=lambda row: bytes(row["model"]))]
        total = sum(n for _, n in models)
        return {k: sum(np.float32(n / total) * m[k] for m, n in models) for k in model} if total else model

    def spread(seed: int):
        return F.xxhash64("draw", "place", "ids", F.lit(seed))

    begin = pieces.orderBy(spread(4), "ids").limit(WARM_PIECES).coalesce(1)
    model = trained(begin, attention.new_model(INPUTS, CLASSES), 0.005, 3)
    turn = F.pmod(spread(2), F.lit(ROUNDS))
    for r in range(ROUNDS):
        part = pieces.filter(turn == r).repartition(workers, spread(3)).sortWithinPartitions(spread(1), "ids").select("place", "ids")
        model = trained(part, model, 0.003 / (r + 1), 1)
    return model


def score_texts(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row of `docs(doc_id, text)`.

    Rows of fold 1 of the id's crc32 are held out, the others are learned from; a null text is an empty one and has its end as
    only token, a null id falls into the fold of the empty text. base_score is the add-a-half unigram of words counted over all
    training texts; score is the attention model's log10 probability of the text's subword ids and its end. Frequent
    words are looked up in a bounded table, the others are joined with their counts, so no word list grows in a task.
    Repeated rows count and are scored each; other columns are ignored; without training texts all counts are 0.
    """
    spark = docs.sparkSession
    if vocabulary is None:
        import public_tokenizers

        vocabulary = public_tokenizers.path("word_bpe_49k.json")
    held = fold(F.col("doc_id")) == 1
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held.alias("held_out"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    learn = rows.filter("not held_out")
    counts = materialise(count_words(learn.select(F.col("text").cast("binary").alias("text"))))
    total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    under = np.log10(total + 0.5 * (distinct + 1))
    head = spark.sparkContext.broadcast(head_counts(counts))

    def make():
        scorer = TextScorer(vocabulary)
        values = {w: float(np.log10(n + 0.5) - under) for w, n in head.value.items()}
        value = values.get
        task, number = TaskContext.get().partitionId() << 40, [0]

        def step(batch: dict) -> dict | None:
            if not batch:
                return None
            out: dict[str, list] = {k: [] for k in ("n_tokens", "known", "base", "words", "times")}
            size = len(batch["text"])
            for text in batch["text"]:
                found = text.lower().split()
                found.append(END_WORD)
                known = np.array(list(map(value, found)), np.float64)  # not a number where a word is rare
                rare = np.isnan(known)
                tail = Counter(compress(found, rare.tolist()))
                out["n_tokens"].append(len(found))
                out["known"].append(len(found) - int(rare.sum()))
                out["base"].append(float(np.nansum(known)))
                out["words"].append(list(tail))
                out["times"].append(list(tail.values()))
            out["row"] = [task + number[0] + k for k in range(size)]
            number[0] += size
            out["doc_id"], out["held_out"], out["ids"] = batch["doc_id"], batch["held_out"], scorer.packed(batch["text"])
            return out

        return step

    # Row numbers are made once, and texts are cut into ids once: what follows reads the written table.
    passed = materialise(arrow_pass(rows.select("doc_id", "held_out", F.col("text").cast("binary").alias("text")),
                                    "row long, doc_id long, held_out boolean, n_tokens long, known long, base double, words array<binary>, times array<long>, ids binary", make))
    symbols = id_counts(counts, vocabulary)
    model = train(passed.filter("not held_out").select(F.xxhash64("doc_id", F.lit(5)).alias("draw"), "ids"), vocabulary, symbols)
    shared = spark.sparkContext.broadcast(pickle.dumps((symbols, model)))

    def make_scores():
        scorer = TextScorer(vocabulary, *pickle.loads(shared.value))

        def step(batch: dict) -> dict | None:
            if not batch:
                return None
            ids = [np.frombuffer(i, "<u2").astype(np.int32) for i in batch.pop("ids")]
            return {**batch, "score": scorer.scores(ids)}

        return step

    scored = arrow_pass(passed.drop("words", "times"), "row long, doc_id long, held_out boolean, n_tokens long, known long, base double, score double", make_scores)
    rare = passed.select("row", F.explode(F.arrays_zip("words", "times")).alias("tail")).select(
        "row", F.col("tail.words").alias("word"), F.col("tail.times").alias("times")).join(counts, "word", "left")
    rest = rare.groupBy("row").agg(
        F.sum(F.col("times") * (F.log10(F.coalesce(F.col("n"), F.lit(0)) + F.lit(0.5)) - F.lit(float(under)))).alias("rest"),
        F.sum(F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0)).alias("found"))
    return scored.join(rest, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("found", F.lit(0))).alias("n_known"), F.lit(int(total)).alias("train_tokens"),
        (F.col("base") + F.coalesce("rest", F.lit(0.0))).alias("base_score"), "score")
