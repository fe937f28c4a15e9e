"""Fill-in-middle over compressed frames against plain string slicing."""

import random
from hashlib import sha256

import pytest

from lossloom.llm import infill

SCHEMA = "doc_id long, text string, n long, form string, data string, ends long, marked long"


def brute(doc_id, text):
    text = text or ""
    n = len(text)
    drawn = sha256(("1:" + ("" if doc_id is None else str(doc_id))).encode()).hexdigest()
    h = [int(drawn[8 * k:8 * k + 8], 16) for k in range(4)]
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return doc_id, n, "plain", None, None, text
    prefix, middle, suffix = text[:low], text[low:high], text[high:]
    form = "spm" if h[3] % 100 < 20 else "psm"
    made = f"<S>{suffix}<P>{prefix}<M>{middle}" if form == "spm" else f"<P>{prefix}<S>{suffix}<M>{middle}"
    return doc_id, n, form, low, high - low, made


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(2)
    signs = ["a", " ", "é", "★", "😀", "<", "P", "S", "M", ">", "\n"]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randrange(60))) for _ in range(150)]
    texts += [None, "", "x", "<P>", "a<M>b", "<P", "S>", "".join(rng.choice("abcé😀 ") for _ in range(50_000)), "★" * 30_000]
    found = list(enumerate(texts))
    return found + found[:5] + [(None, "no id"), (None, "no id"), (None, "other"), (7, "same id"), (-5, "negative")]


@pytest.mark.parametrize("frame_bytes", [4, 7, 4096, 1 << 16])
def test_outputs_and_round_trip(spark, rows, frame_bytes):
    some = rows if frame_bytes > 7 else [r for r in rows if len(r[1] or "") < 100]
    docs = spark.createDataFrame([(i, t, 1, "x", "y", 2, 3) for i, t in some], SCHEMA)
    got = infill.fill_in_middle(docs, frame_bytes).collect()
    want = [brute(*r) for r in some]

    def digest(text):
        return sha256(text.encode()).hexdigest()

    expected = [(*w[:5], digest(w[5]), digest(r[1] or "")) for w, r in zip(want, some)]
    assert sorted(map(tuple, got), key=str) == sorted(expected, key=str)


def test_store_holds_small_frames_and_reads_ranges(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for row in infill.store_texts(docs, 512).filter("doc_id >= 150").collect():
        text = dict(rows)[row["doc_id"]] or ""
        reader = infill.Reader(row["data"], row["ends"], row["units"])
        frames = [f.decode() for f in reader.stream()]
        assert "".join(frames) == text and all(len(f.encode()) <= 512 for f in frames) and len(reader) == len(text)
        for low, high in ((0, len(text)), (len(text) // 3, len(text) // 2), (len(text), len(text))):
            writer = infill.Writer(512)
            infill.Reader(row["data"], row["ends"], row["units"]).copy(low, high, writer)
            assert b"".join(infill.Reader(*writer.take()).stream()).decode() == text[low:high]


def test_only_cut_frames_are_opened():
    writer = infill.Writer(64)
    writer.text(b"abcdefgh" * 800)
    text = infill.Reader(*writer.take())
    opened = []
    unpack = text.unpack
    text.unpack = lambda data: opened.append(1) or unpack(data)
    infill.rearrange(text, "psm", 1000, 4001, writer)
    assert len(opened) == 2 and len(text.ends) == 100


def test_empty_table(spark):
    assert infill.fill_in_middle(spark.createDataFrame([], SCHEMA)).count() == 0
