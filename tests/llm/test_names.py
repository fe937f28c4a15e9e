"""Null ids that link others, and input columns whose names clash with inner ones."""

from lossloom.llm import language, paragraphs, simhash


def test_null_ids_link_fingerprints(spark, monkeypatch):
    prints = spark.createDataFrame([(1, 0x00), (None, 0x0F), (2, 0xFF), (None, 1 << 40), (9, -1)], "doc_id long, fp long")
    monkeypatch.setattr(simhash, "fingerprints", lambda docs, shingle: docs)
    got = {(r["doc_id"], r["fp"]): r["component_id"] for r in simhash.near_duplicates(prints).collect()}
    assert [got[k] for k in ((1, 0x00), (None, 0x0F), (2, 0xFF))] == [1, 1, 1]
    assert got[(9, -1)] == 9 and got[(None, 1 << 40)] == 1  # one bit from zero
    alone = simhash.near_duplicates(prints.filter("doc_id is null")).collect()
    assert len(alone) == 2 and {r["component_id"] for r in alone} == {None}


NAMES = ("guess", "GUESS_", "id", "hash", "places", "text_hash", "__id", "row", "class")


def clashing(spark, rows):
    schema = "doc_id long, text string, lang string, " + ", ".join(f"`{n}` int" for n in NAMES)
    return spark.createDataFrame([(i, t, lang, *range(len(NAMES))) for i, t, lang in rows], schema)


def test_language_keeps_clashing_columns(spark):
    rows = [(k, "the cat and the dog" if k % 2 else "der hund und die katze", "en" if k % 2 else "de") for k in range(60)] + [(None, None, None)]
    got = language.identify(clashing(spark, rows), per_language=50).collect()
    assert len(got) == 61 and all(tuple(r[n] for n in NAMES) == tuple(range(len(NAMES))) for r in got)
    assert all(r["lang_pred"] == r["lang"] for r in got if r["text"])


def test_paragraphs_keep_clashing_columns(spark):
    line = " ".join(f"w{k}" for k in range(60))
    other = " ".join(f"v{k}" for k in range(60))
    got = paragraphs.drop_repeated(clashing(spark, [(1, line, "en"), (2, f"{other}\n{line}", "en"), (None, "short", None), (3, None, None)])).collect()
    rows = {r["doc_id"]: r for r in got}
    assert all(tuple(r[n] for n in NAMES) == tuple(range(len(NAMES))) for r in got)
    assert rows[1]["text"] == line and rows[2]["text"] == other
    assert [rows[k]["has_repeated"] for k in (1, 2, None, 3)] == [True, True, False, False]
