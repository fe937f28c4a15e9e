"""Token counts of a unigram tokenizer: one forward pass over a trie of the distinct words of a task."""

from __future__ import annotations

import functools
import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lossloom.llm.common import arrow_pass, as_bytes

WORD_START = "▁"
CACHE = 400_000


@functools.cache
def pieces(path: str) -> tuple[dict[str, float], int, float]:
    """Scores of the ordinary pieces of a sentencepiece file, the longest piece, and the score of one unknown byte.

    The file lists pieces from frequent to rare without probabilities; by Zipf's law the k-th has a share of 1/k.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    plain = [model.id_to_piece(i) for i in range(model.vocab_size())
             if not (model.is_unknown(i) or model.is_control(i) or model.is_byte(i) or model.is_unused(i))]
    total = math.log(sum(1 / k for k in range(1, len(plain) + 1)))
    scores = {p: -math.log(k) - total for k, p in enumerate(plain, 1)}
    return scores, max(map(len, scores), default=1), min(scores.values(), default=0.0) - 10.0


def count_words(distinct: list[str], scores: dict[str, float], longest: int, unknown: float) -> dict[str, int]:
    """Number of pieces in the best segmentation of every word.

    Sorted words walk the trie depth first. The stack holds, for the prefix of each length on the path, the best
    score and its number of pieces; a word reuses the stack of the prefix that it shares with the one before, so every trie
    node is computed once. Of equal scores fewer pieces win. A character that no piece covers costs its UTF-8 bytes.
    """
    out: dict[str, int] = {}
    best: list[tuple[float, int]] = [(0.0, 0)]
    before = ""
    for word in sorted(distinct):
        text = WORD_START + word
        shared = 0
        for a, b in zip(text, before):
            if a != b:
                break
            shared += 1
        del best[shared + 1:]
        for end in range(len(best), len(text) + 1):
            n = len(text[end - 1].encode("utf-8", "surrogatepass"))
            top, count = best[end - 1][0] + unknown * n, best[end - 1][1] + n
            for start in range(max(0, end - longest), end):
                score = scores.get(text[start:end])
                if score is not None:
                    score += best[start][0]
                    if score > top or score == top and best[start][1] + 1 < count:
                        top, count = score, best[start][1] + 1
            best.append((top, count))
        out[word] = best[-1][1]
        before = text
    return out


def token_counts(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """(doc_id, n_words, n_tokens) for every row of `docs(doc_id, text)`; `vocabulary` is the path of a sentencepiece file.

    Words are split at white space. Each task counts the words that it has not met before and keeps at most CACHE of them;
    nothing is shuffled. A null or empty text has 0 words and 0 tokens; other columns are ignored, repeated rows are
    counted each.
    """
    if vocabulary is None:
        import public_tokenizers

        vocabulary = public_tokenizers.path("piece_bpe_32k.model")

    def make():
        scores, longest, unknown = pieces(vocabulary)
        cache: dict[str, int] = {}

        def step(batch: dict) -> dict | None:
            if not batch:
                return None
            split = [t.decode("utf-8", "replace") .translate(BREAKS).split(" ") for t in batch["text"]]
            fresh = set().union(*split) - cache.keys()
            if len(cache) + len(fresh) > CACHE:
                cache.clear()
                fresh = set().union(*split)
            fresh.discard("")
            cache.update(count_words(list(fresh), scores, longest, unknown))
            cache[""] = 0
            return {"doc_id": batch["doc_id"], "n_words": [len(w) - w.count("") for w in split],
                    "n_tokens": [sum(map(cache.__getitem__, w)) for w in split]}

        return step

    return arrow_pass(docs.select(F.col("doc_id").cast("long").alias("doc_id"), as_bytes(F.col("text")).alias("text")),
                      "doc_id long, n_words long, n_tokens long", make)


BREAKS = {c: " " for c in range(0x09, 0x0E)}
