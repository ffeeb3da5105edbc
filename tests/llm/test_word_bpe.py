"""Word byte-pair encoding against the tokenizers library, and its lexicon against a dict."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from starloom.llm import lexicon, word_bpe
from starloom.llm.common import Memory
from starloom.llm.lexicon import Lexicon, compile_lexicon, ragged
from starloom.llm.queries import QUERIES
from starloom.llm.word_bpe import WordBpe, build_lexicon, encode_texts, encode_words
from tests.llm.brute import documents

PATH = public_tokenizers.path("word_bpe_49k.json")
library = Tokenizer.from_file(PATH)
bpe = WordBpe(PATH)


def lib_ids(text):
    return library.encode(text or "", add_special_tokens=False).ids


def lib_text(ids):
    return library.decode(ids, skip_special_tokens=False)


def looked_up(words, entries):
    """What a lexicon of ``entries`` says to each word: ids or None."""
    known = Lexicon(compile_lexicon(sorted(entries.items())) + lexicon.MAGIC)
    data = np.frombuffer(b"".join(words), dtype=np.uint8)
    sizes = np.array([len(word) for word in words], dtype=np.int64)
    found, counts, ids = known.look_up(data, np.cumsum(sizes) - sizes, sizes)
    parts = np.split(ids, np.cumsum(counts)[:-1]) if words else []
    return [tuple(part.tolist()) if yes else None for yes, part in zip(found, parts)], known


def test_lexicon_is_a_map(monkeypatch):
    monkeypatch.setattr(lexicon, "WALKED", 50)
    draw = random.Random(1)
    for letters in ("ab", "abcdefgh", "aé日"):
        entries = {}
        for _ in range(300):
            word = "".join(draw.choice(letters) for _ in range(draw.randrange(1, 9))).encode()
            entries[word] = tuple(draw.randrange(5) for _ in range(draw.randrange(4)))
        words = [*entries, *(word[:-1] for word in entries), *(word + b"a" for word in entries)]
        words += [b"", b"zzz", b"a" * 60]
        made, _ = looked_up(words, entries)
        assert made == [entries.get(word) for word in words]


def test_lexicon_shares_suffixes():
    """Minimal: words of one ending and output share all of its states."""
    ends = [b"ation", b"ing", b"ed"]
    words = {a + b: (i, 7) for i, a in enumerate([b"bx", b"cy", b"dz"]) for b in ends}
    made, known = looked_up(list(words), words)
    assert made == list(words.values())
    # A root, three first letters' states, one for all second letters, and the endings' states.
    tree = {word[:size] for word in words for size in range(len(word) + 1)}
    assert known.states < len(tree) / 2


def test_lexicon_of_nothing_and_broken_files():
    assert looked_up([b"a", b""], {})[0] == [None, None]
    assert looked_up([], {b"a": (1,)})[0] == []
    with pytest.raises(ValueError, match="not a lexicon"):
        Lexicon(b"something else")
    with pytest.raises(ValueError, match="sorted"):
        compile_lexicon([(b"b", (1,)), (b"a", (2,))])


def test_ragged():
    pool = np.arange(10)
    assert ragged(pool, np.array([7, 0, 3]), np.array([2, 0, 3])).tolist() == [7, 8, 3, 4, 5]
    assert ragged(pool, np.array([], dtype=int), np.array([], dtype=int)).tolist() == []


def texts():
    draw = random.Random(5)
    special = ["it's", "IT'S", "we'll've", "<|endoftext|>", "a<|startoftext|>b", "<|end", "x\x85y", "x\xa0y",
               "ΣΑΣ", "İx", "é", "́e", "中文字", "½²3", "🙂👍🏽", "﻿x", "\x1cy", "ǆ", "ß", "ﬁ", "''s",
               "1234", "a1b2", "...", "—dash—", "À", "​", "اًب", "ẞ", "Ạ̊"]
    made = [" ".join(draw.choice(special) for _ in range(draw.randrange(9))) for _ in range(150)]
    for _ in range(300):
        size = draw.randrange(30)
        made.append("".join(chr(draw.choice([draw.randrange(32, 127), draw.randrange(160, 700),
                                             32, 10, draw.randrange(0x300, 0x2FFF)])) for _ in range(size)))
    return [*made, "", " ", "\n\t lead and trail \r\n", "a" * 5000 + "b", "xy" * 400, "é" * 300]


@pytest.mark.parametrize("slice_bytes", [64, 8 << 20])
def test_ids_and_text_equal_the_library(monkeypatch, slice_bytes):
    monkeypatch.setattr(word_bpe, "SLICE_BYTES", slice_bytes)
    monkeypatch.setattr(word_bpe, "BLOCK_BYTES", max(1, slice_bytes // 3))
    rows = texts()
    words = sorted({w for text in rows for w in text.encode().split()})[::2]
    entries = [(w, tuple(bpe.word_ids(w))) for w in words if len(w) <= lexicon.WORD_BYTES]
    known = Lexicon(compile_lexicon(entries) + lexicon.MAGIC)
    merged = Memory(lambda w: np.array(bpe.word_ids(w), dtype="<u4").tobytes(), 50)
    made = encode_texts([text.encode() for text in rows], bpe, known, merged)
    for text, ids in zip(rows, made):
        ids = np.frombuffer(ids, dtype="<u4")
        assert ids.tolist() == lib_ids(text), text
        assert bpe.decode(ids).decode() == lib_text(ids.tolist())


def test_both_ways_of_merging(monkeypatch):
    draw = random.Random(8)
    words = [bytes(draw.choice(b"abcdeinorst") for _ in range(draw.randrange(1, 60))) for _ in range(300)]
    words += [b"a" * n for n in range(1, 30)]
    plain = [bpe._merged(word) for word in words]
    monkeypatch.setattr(word_bpe, "SHORT", 0)
    assert [bpe._merged(word) for word in words] == plain
    assert plain == [lib_ids(word.decode()) for word in words]


def check(spark, rows, **settings):
    found = encode_words(documents(spark, rows), PATH, **settings)
    held = sorted((str(r.doc_id), list(np.frombuffer(r.ids, "<u4")), r.decoded) for r in found.collect())
    assert held == sorted((str(i), lib_ids(t), lib_text(lib_ids(t))) for i, t in rows)


def test_tables(spark):
    rows = [(i, text) for i, text in enumerate(texts())]
    check(spark, [*rows, (None, None), (7, "again"), (7, "again"), (None, "x y z " * 5)])
    assert encode_words(documents(spark, []), PATH).collect() == []


def test_very_long_text(spark):
    check(spark, [(1, "some words and more " * 400_000), (2, "y" * 200_000), (3, "short")])


def test_a_lexicon_is_chosen_by_frequency(spark, monkeypatch):
    monkeypatch.setattr(word_bpe, "LEXICON_WORDS", 2)
    rows = [(1, "often often often often some some some twice twice rare")]
    df = documents(spark, rows)
    counts = word_bpe.word_counts(df)
    assert {(bytes(r.word), r.n) for r in counts.collect()} == {
        (b"often", 4), (b"some", 3), (b"twice", 2), (b"rare", 1)}
    chosen = word_bpe.frequent_words(counts, 2).collect()
    assert {bytes(r.word) for r in chosen} == {b"often", b"some"}
    # Words of one frequency are in or out together.
    assert word_bpe.frequent_words(counts.withColumn("n", F.lit(5).cast("long")), 3).count() == 0
    name = build_lexicon(df, PATH)
    check(spark, [*rows, (2, "other words, often")], lexicon_name=name)


def test_clashing_columns(spark):
    df = documents(spark, [(1, "a b"), (2, None)]).withColumnRenamed("text", "body")
    for name in ("text", "text_", "ids", "DECODED", "word", "n", "a.b"):
        df = df.withColumn(name, F.lit("x"))
    made = encode_words(df, PATH, text_column="body")
    assert made.columns == [c for c in df.columns if c not in ("ids", "DECODED")] + ["ids", "decoded"]
    row = made.where("doc_id = 1").first()
    assert (row.body, row["a.b"], row.text) == ("a b", "x", "x")
    assert list(np.frombuffer(row.ids, "<u4")) == lib_ids("a b")
    assert made.where("doc_id = 2").first().body is None


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError, match="not a byte-pair encoding of words"):
        WordBpe(public_tokenizers.path("byte_bpe_50k.json"))


def test_query(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    expected = set()
    for row in rows:
        ids = lib_ids(row.text)
        digest = hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest()
        decoded = hashlib.sha256(lib_text(ids).encode()).hexdigest()
        expected.add((row.doc_id, len(ids), digest, decoded))
    found = QUERIES["op12_word_bpe"](spark, sf_dir)
    assert found.dtypes[1] == ("n_tokens", "bigint")
    assert {tuple(row) for row in found.collect()} == expected and found.count() == len(rows)
