"""Registered queries and the pipeline as a whole, on tables written to a folder, row by row against plain Python where there is an answer to compare."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from llm_fixtures import documents, words  # noqa: F401
from tokenizers import Tokenizer

import __spark_entry__ as entry

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(VOCABULARY)


def run_on(spark, name, folder, **frames):
    for table, frame in frames.items():
        frame.write.parquet(f"{folder}/{table}.parquet")
    return entry.queries()[name](spark, str(folder)).collect()


def pieces_by_hand(tokenizer, rows):
    """(doc_id, piece, start, length, crc) of every piece."""
    found = []
    for doc_id, text in rows:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        first = len(ids) % 2048 or 2048
        bounds = [0, *range(min(first, len(ids)), len(ids) + 1, 2048)]
        for number, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False)):
            found.append((doc_id, number, a, b - a, zlib.crc32(ids[a:b].tobytes())))
    return Counter(found)


def check_packing(tokenizer, found, rows, most=None):
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in found) == pieces_by_hand(tokenizer, rows)
    sequences = defaultdict(list)
    for r in found:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for held in sequences.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 2048
    if most is not None:
        assert len(sequences) <= most


def test_packing_query(spark, documents, words, tokenizer, tmp_path):
    rng = random.Random(1)
    rows = [(i, " ".join(words(rng.choice([1, 10, 300, 700])))) for i in range(60)] + [(100, " ".join(words(6000))), (101, None), (102, ""), (None, "a b"), (3, "x y z"), (3, "x y z")]
    found = run_on(spark, "op2_best_fit_packing", tmp_path, documents=documents(rows))
    lengths = [n for _i, _p, _s, n, _c in pieces_by_hand(tokenizer, rows).elements()]
    # Pieces of over half a sequence need one each, and the others fill at least half of any sequence but one.
    check_packing(tokenizer, found, rows, most=sum(n > 1024 for n in lengths) + sum(n for n in lengths if n <= 1024) // 1024 + 1)


def test_html_query(spark, tmp_path):
    pages = [(1, "u1", "<body><nav><a href=x>Menu</a></nav><article><p>First, here.</p><p>Second &amp; last,\n there.</p></article></body>"),
             (2, "u2", None), (3, None, ""), (None, "u4", "<form><p>Wrapped, all of it. Yes.</p><p>More, too.</p></form>")]
    frame = spark.createDataFrame([(*p, "mine", 5) for p in pages], "page_id LONG, url STRING, html STRING, text STRING, n_chars INT")
    found = run_on(spark, "op6_html_extraction", tmp_path, pages=frame)
    expected = ["First, here.\nSecond & last, there.", "", "", "Wrapped, all of it. Yes.\nMore, too."]
    assert Counter((r["page_id"], r["url"], r["text"], r["n_chars"]) for r in found) == Counter((i, u, t, len(t)) for (i, u, _h), t in zip(pages, expected, strict=True))


KINDS = {"en": "theandoig", "fr": "éàoiuxles", "es": "ñcóadelos"}


def test_language_query(spark, documents, words, tmp_path):
    rows = [(n, " ".join(words(25, letters)), lang) for n, (lang, letters) in enumerate(list(KINDS.items()) * 30)] + [(900, None, "en"), (901, "1 2 !", "fr")]
    found = run_on(spark, "op8_language_id", tmp_path, documents=documents(rows))
    assert len(found) == len(rows)
    truth = {i: lang for i, _t, lang in rows}
    for r in found:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1
        assert r["lang_pred"] == ("und" if r["doc_id"] >= 900 else truth[r["doc_id"]])


def test_quality_query(spark, documents, words, tmp_path):
    """Two kinds of text that differ in their statistics; held-out rows are told apart without their labels."""
    rng = random.Random(3)
    good = [(i, ". ".join(" ".join(words(rng.randint(6, 12))).capitalize() for _ in range(rng.randint(5, 15))) + ".") for i in range(0, 240, 2)]
    bad = [(i, " ".join(rng.choice(["BUY", "$$$", "!!!", "1234", "click"]) for _ in range(rng.randint(5, 60)))) for i in range(1, 240, 2)]
    labels = spark.createDataFrame([(i, int(i % 2 == 0), 0) for i, _t in good + bad], "doc_id LONG, quality INT, toxic INT")
    found = run_on(spark, "op7_quality_classifier", tmp_path, documents=documents([*good, *bad, (1000, None), (1001, "")]), labels=labels)
    assert len(found) == 242
    for r in found:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) and 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
    held = [r for r in found if r["held_out"] and r["doc_id"] < 1000]
    assert sum(r["predicted"] == int(r["doc_id"] % 2 == 0) for r in held) > 0.9 * len(held) > 20


def test_pipeline_row_by_row(spark, documents, words, tokenizer, tmp_path):
    """Every stage's decision is seen in the pieces at the end: what goes, what stays, what is cut and what is masked."""
    import corpus_pipeline

    def prose(n=80):
        return " ".join(words(n, KINDS["en"], 8))

    shared, copied = prose(60), prose()
    plain = [(i, prose(), "en") for i in range(20, 40)] + [(i, " ".join(words(80, KINDS["fr"], 8)), "fr") for i in range(40, 60)]
    rows = [
        *plain, (1, copied, "en"), (2, copied, "en"), (3, copied.upper(), None), (4, None, "en"), (5, "123 !! 456", "en"), (6, "", "en"),
        (7, f"{prose(70)} {shared}", "en"), (8, f"{shared} {prose(70)}", "en"), (9, prose(30) + " password = hunter2secret99 and more of it", "en"),
        (None, prose(40), "en"), (10, " ".join(words(4000, KINDS["es"], 8)), "es"),
    ]
    text = {i: t for i, t, _l in rows}
    kept = dict(text)
    # A copy in other letters has the same words; the smallest id of a group stays. A passage stays in the document with the smaller id.
    for gone in (2, 3, 4, 5, 6):
        del kept[gone]
    kept[8] = text[8].removeprefix(shared + " ")
    kept[9] = re.sub("password = hunter2secret99", "[SECRET]", text[9])
    documents(rows).write.parquet(str(tmp_path / "documents.parquet"))
    check_packing(tokenizer, corpus_pipeline.run(spark, str(tmp_path)).collect(), list(kept.items()))


def test_pipeline_on_nothing_and_on_odd_rows(spark, documents, tmp_path, tokenizer):
    import corpus_pipeline

    documents([]).write.parquet(str(tmp_path / "none" / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path / "none")).collect() == []
    rows = [(None, "some words here"), (None, "some words here"), (None, None), (1, "one two three"), (1, "one two three")]
    documents(rows).write.parquet(str(tmp_path / "odd" / "documents.parquet"))
    found = corpus_pipeline.run(spark, str(tmp_path / "odd")).collect()
    # Rows without an id cannot be told apart and stay; of repeated rows one does.
    check_packing(tokenizer, found, [(None, "some words here")] * 2 + [(1, "one two three")])
