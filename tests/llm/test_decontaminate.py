from __future__ import annotations

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from starloom.llm import decontaminate
from starloom.llm.decontaminate import (
    NAME,
    NUMBER,
    UNIT,
    WORD,
    Tokens,
    Windows,
    consistent_tokens,
    drop_leaks,
    find_leaks,
    template,
)
from starloom.llm.queries import QUERIES
from tests.llm.brute import documents, words

ITEMS = "item_id bigint, text string"
QUESTION = (
    "Tom walks 12 km to school every morning. After that Tom meets Anna, who has 7 red apples, "
    "and Anna gives 3 apples to Tom. How many apples are left in the small basket of Anna?"
)
CLEAN = "The river was calm and nobody spoke about anything while the boats went slowly past. " * 5


def kinds(text):
    return template(text)[1].tolist()


def test_types_of_tokens():
    assert kinds("Tom ran 5 km to Rome. He paid 10% or $3.") == [
        WORD, WORD, NUMBER, UNIT, WORD, NAME, WORD, WORD, NUMBER, UNIT, WORD, UNIT, NUMBER
    ]
    assert kinds("ALL CAPS here I go\nNext one") == [0, 0, 0, 0, 0, WORD, NUMBER]
    assert kinds("km 5") == [WORD, NUMBER]
    assert kinds(" ... ! x") == [WORD] and kinds("") == [] and kinds("It's l’eau") == [0, 0]


def test_texts_of_a_slice_are_apart():
    """Neither types nor windows reach from one text into the next."""
    texts = [QUESTION, "", "12", "km and Tom. ", "Anna walks", "\n\n", "x" * 9, CLEAN] * 2
    together = Tokens(pa.array(texts))
    for row, text in enumerate(texts):
        hashes, types = template(text)
        here = together.row == row
        assert (together.hashes[here] == hashes).all() and (together.kinds[here] == types).all()
        assert together.counts[row] == len(hashes)
    made = Windows(together, together.kinds, 0).hashes(8)
    alone = [Windows(t, t.kinds, 0).hashes(8) for t in (Tokens(pa.array([x])) for x in texts)]
    assert made.tolist() == [x for part in alone for x in part.tolist()]


def leaks(spark, docs, items=((1, QUESTION),)):
    found = find_leaks(documents(spark, docs), spark.createDataFrame(list(items), ITEMS))
    return {(r.doc_id, r.item_id) for r in found.collect()}


def changed(**values):
    text = QUESTION
    for old, new in values.items():
        text = text.replace(old.strip("_"), new)
    return text


def test_verbatim_and_reparameterised_questions(spark):
    docs = [
        (1, CLEAN + QUESTION + " " + CLEAN),
        (2, CLEAN + changed(Tom="Peter", Anna="Maria", _12="35", _7="9", _3="4", km="miles")),
        (3, QUESTION.lower()),
        (4, CLEAN),
        (5, CLEAN + "and then " + QUESTION[:110]),
        (6, None),
        (7, ""),
        (None, QUESTION),
        (8, QUESTION), (8, QUESTION),
        (9, CLEAN * 400 + QUESTION),
        (10, QUESTION.upper()),
    ]
    assert leaks(spark, docs) == {(i, 1) for i in (1, 2, 3, 5, 8, 9, 10, None)}


def test_slots_must_agree(spark):
    """The template fits, but several names stand in each window where the item has one."""
    item = "Tom met Anna and Tom met Eva while Tom met Ida and Tom met Lea"
    other = "Al met Bo and Cy met Di while Ed met Fay and Gus met Hal"
    renamed = "Al met Bo and Al met Di while Al met Fay and Al met Hal"
    docs = [(1, other), (2, renamed), (3, item), (4, CLEAN + "Then " + renamed)]
    assert leaks(spark, docs, [(1, item)]) == {(2, 1), (3, 1), (4, 1)}


def test_a_clash_hides_only_its_windows(spark):
    merged = QUESTION.replace("Anna", "Tom")
    split = QUESTION.replace("gives 3 apples to Tom", "gives 3 apples to Eva")
    assert leaks(spark, [(1, merged), (2, split), (3, CLEAN)]) == {(1, 1), (2, 1)}


def test_short_and_empty_items(spark):
    items = [(1, "a short item of words"), (2, "12 and 13"), (3, None), (4, ""), (4, "")]
    docs = [(1, CLEAN + "a short item of words"), (2, "12 and 13"), (3, "")]
    assert leaks(spark, docs, items) == {(1, 1), (2, 2)}
    assert leaks(spark, [], items) == set() and leaks(spark, docs, []) == set()


def test_items_of_a_word_drop_no_texts(spark):
    """They count where a line is nothing else."""
    items = [(1, "Paris"), (2, "12"), (3, "the"), (4, "New York City")]
    docs = [(i, f"{CLEAN} The man of {i} saw Paris and the 12 towns of New York City") for i in range(20)]
    docs += [(50, "Paris"), (51, f"{CLEAN}\nnew york city.\n{CLEAN}"), (52, "so it was\n12"),
             (53, "the\nend"), (54, "Paris 12"), (55, "in\nParis it is")]
    assert leaks(spark, docs, items) == {(50, 1), (51, 4), (52, 2), (53, 3)}


def plain_tokens(text):
    """``low, kind, opening, line`` of each token."""
    made, opens, line, number = [], True, 0, False
    for token in decontaminate._TOKEN.findall(text or ""):
        if token[0] in ".!?\n":
            opens, line = True, line + (token == "\n")
            continue
        low = token.lower()
        capital = token[0] != low[0] and len(token) > 1 and token[1:] == low[1:]
        kind, opening = WORD, False
        if token[0].isdigit() or low in decontaminate.NUMBER_WORDS:
            kind = NUMBER
        elif token in decontaminate.SIGNS or low in decontaminate.UNITS and number:
            kind = UNIT
        elif capital:
            kind, opening = (WORD, True) if opens else (NAME, False)
        number = kind == NUMBER
        made.append((low, kind, opening, line))
        opens = False
    return made


def plain_windows(text, sizes=None):
    """``size, coded -> {place: slots}`` over all readings."""
    tokens = plain_tokens(text)
    found = {}
    for reading in range(3):
        kinds = [WORD if reading == 2 else NAME if reading == 1 and t[2] else t[1] for t in tokens]
        for size in sizes or [min(8, len(tokens))]:
            for i in range(len(tokens) - size + 1 if size else 0):
                here = list(zip(tokens[i : i + size], kinds[i : i + size]))
                if reading < 2 and sum(kind == WORD for _, kind in here) < 4:
                    continue
                if sizes and size < 4:
                    lines = {t[3] for t, _ in here}
                    if len(lines) > 1 or sum(t[3] in lines for t in tokens) != size:
                        continue
                coded = tuple(t[0] if kind == WORD else kind for t, kind in here)
                slots = tuple(None if kind == WORD else (t[0], kind) for t, kind in here)
                found.setdefault((size, coded), {})[i] = slots
    return found, len(tokens)


def covered(places, size):
    return len({place + i for place in places for i in range(size)})


def plain_leaks(docs, items):
    found = {}
    of_items = {i: plain_windows(text) for i, text in items}
    sizes = sorted({size for windows, _ in of_items.values() for size, _ in windows})
    for doc_id, text in docs:
        of_doc, _ = plain_windows(text, sizes) if sizes else ({}, 0)
        for item_id, (windows, tokens) in of_items.items():
            aligned = {}
            for key, places in windows.items():
                for place, slots in places.items():
                    for doc_place, doc_slots in of_doc.get(key, {}).items():
                        pairs = frozenset((a, b) for a, b in zip(slots, doc_slots) if a)
                        aligned.setdefault((key[0], doc_place - place), set()).add((place, pairs))
            for (size, _), held in aligned.items():
                every = {pair for _, pairs in held for pair in pairs}
                best = covered({place for place, _ in held}, size)
                if not len(every) == len({a for a, _ in every}) == len({b for _, b in every}):
                    best = plain_consistent(sorted(held, key=lambda x: (x[0], sorted(map(str, x[1])))), size)
                if best >= min(13, -(-tokens // 2)):
                    found[doc_id, item_id] = max(best, found.get((doc_id, item_id), 0))
    return found


def plain_consistent(held, size):
    """The most tokens of one run of windows without a clash, or of all unchanged ones."""
    best = covered({place for place, pairs in held if all(a == b for a, b in pairs)}, size)
    for i in range(len(held)):
        for j in range(i, len(held)):
            pairs = {pair for _, each in held[i : j + 1] for pair in each}
            if len(pairs) == len({a for a, _ in pairs}) == len({b for _, b in pairs}):
                best = max(best, covered({place for place, _ in held[i : j + 1]}, size))
    return best


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equals_plain_version(spark, monkeypatch, seed):
    draw = random.Random(seed)
    pools = [["apple", "walks", "to", "the", "and", "of", "sees", "It's"], ["Tom", "Anna", "Eva", "Rome"],
             ["3", "7", "12", "two", "3.5"], ["km", "kg", "%", "$", "hours"]]

    def text(size):
        words = [draw.choice(pools[draw.choice([0, 0, 0, 1, 2, 3])]) for _ in range(size)]
        return "".join(w + draw.choice([" "] * 9 + [". ", "\n", ", "]) for w in words)

    items = [(i, text(draw.choice([1, 2, 3, 4, 6, 8, 9, 14, 25, 40]))) for i in range(25)] + [(90, None)]
    docs = []
    for i in range(70):
        body = items[draw.randrange(25)][1]
        for old in draw.sample(pools[1] + pools[2], draw.randrange(4)):
            body = body.replace(old, draw.choice(pools[1 + (old in pools[2])]), draw.choice([1, -1]))
        docs.append((i, text(draw.randrange(30)) + draw.choice(["", "\n"]) + body + text(draw.randrange(12))))
    monkeypatch.setattr(decontaminate, "SLICE_BYTES", 2000)
    found = find_leaks(documents(spark, docs), spark.createDataFrame(items, ITEMS)).collect()
    ours, plain = {(r.doc_id, r.item_id): r.matched_tokens for r in found}, plain_leaks(docs, items)
    # The majority of slots may cover more than one run; nothing else differs.
    assert ours.keys() >= plain.keys() and len(plain) > 20
    assert all(ours[pair] >= plain[pair] for pair in plain)
    more = [pair for pair in ours if ours[pair] != plain.get(pair)]
    for doc_id, item_id in more:
        assert majority(dict(docs)[doc_id], dict(items)[item_id]) == ours[doc_id, item_id]


def majority(doc, item):
    """The best of all alignments by the operator's own rule for clashes."""
    windows, _ = plain_windows(item)
    of_doc, _ = plain_windows(doc, sorted({size for size, _ in windows}))
    aligned = {}
    for key, places in windows.items():
        for place, slots in places.items():
            for doc_place, doc_slots in of_doc.get(key, {}).items():
                pairs = frozenset((a, b) for a, b in zip(slots, doc_slots) if a)
                aligned.setdefault((key[0], doc_place - place), set()).add((place, pairs))
    number = {}

    def coded(pairs):
        return [tuple(number.setdefault(x, len(number)) for x in pair) for pair in pairs]

    return max(
        max(consistent_tokens([(place, coded(pairs)) for place, pairs in held], size), plain_consistent(list(held), size))
        for (size, _), held in aligned.items()
    )


def test_leaks_are_dropped(spark):
    rows = [(1, QUESTION), (2, CLEAN), (None, QUESTION), (None, CLEAN), (2, QUESTION), (3, None)]
    docs = documents(spark, rows)
    for name in ("hash", "size", "key", "dropped", "doc_id_", "item_id", "place"):
        docs = docs.withColumn(name, F.lit("x"))
    items = spark.createDataFrame([(1, QUESTION)], ITEMS)
    left = drop_leaks(docs, items)
    assert left.columns == docs.columns
    assert {(r.doc_id, r.text) for r in left.collect()} == {(2, CLEAN), (None, CLEAN), (3, None)}


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.01"])
def test_query_finds_verbatim_items_only(spark, sf_dir, folder):
    base = sf_dir.replace("sf0.001", folder)
    docs = dict(spark.read.parquet(f"{base}/documents.parquet").select("doc_id", "text").collect())
    items = dict(spark.read.parquet(f"{base}/benchmark.parquet").select("item_id", "text").collect())
    found = {(r.doc_id, r.item_id) for r in QUERIES["op3_decontamination"](spark, base).collect()}
    verbatim = {(d, i) for d, text in docs.items() for i, item in items.items() if item in text}
    assert verbatim and verbatim <= found
    for doc_id, item_id in found - verbatim:
        item, text = words(items[item_id]), " ".join(words(docs[doc_id]))
        runs = (" ".join(item[i : i + 7]) for i in range(len(item) - 6))
        assert any(run in text for run in runs)


def query_leaks(spark, tmp_path, docs, items=((1, QUESTION),)):
    """What op3 reports, and what the pipeline's stage leaves."""
    table = documents(spark, docs)
    table.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(list(items), ITEMS).write.parquet(f"{tmp_path}/benchmark.parquet")
    found = {(r.doc_id, r.item_id) for r in QUERIES["op3_decontamination"](spark, str(tmp_path)).collect()}
    stage = dict(corpus_pipeline.STAGES)["decontamination"]
    left = {r.doc_id for r in stage(spark, table, str(tmp_path)).collect()}
    assert left == {i for i, _ in docs} - {i for i, _ in found}
    return found


def test_one_edited_value_does_not_hide_a_passage(spark, tmp_path):
    docs = [
        (1, CLEAN + QUESTION.replace("gives 3 apples to Tom", "gives 3 apples to Eva")),
        (2, QUESTION.replace("7 red", "12 red")),
        (3, changed(Tom="Peter", Anna="Maria").replace("to Peter. How", "to Eva. How")),
        (4, CLEAN),
    ]
    assert query_leaks(spark, tmp_path, docs) == {(1, 1), (2, 1), (3, 1)}


def test_consistent_tokens():
    a, b, c = (1, 1), (1, 2), (2, 2)
    assert consistent_tokens([(0, [a]), (1, [a]), (9, [b])], 8) == 9
    assert consistent_tokens([(0, [b]), (8, [b, (3, 4)]), (30, [c])], 8) == 16
    assert consistent_tokens([(0, [(1, 5)]), (4, [(1, 6)]), (5, [(1, 6)])], 8) == 9
    assert consistent_tokens([(0, [a, b])], 8) == 0 and consistent_tokens([], 8) == 0


def test_items_of_few_words_and_capitals_are_found(spark, tmp_path):
    items = [
        (1, "What is 12 + 30?"),
        (2, "3 1 4 1 5 9 2 6 5 3 5 8 9 7 9 3"),
        (3, "What is the capital city of France"),
        (4, "Tom Anna Peter Maria Paul Eva Otto Ida Max Lena Karl Rosa Emil Jana"),
        (5, "Which river flows through the old town of Prague"),
    ]
    docs = [
        (1, CLEAN + "what is 12 + 30? Nobody knew."),
        (2, CLEAN + "so 3 1 4 1 5 9 2 6 5 3 5 8 9 7 9 3 it went"),
        (3, "Question: What is the capital city of France"),
        (4, CLEAN + items[3][1].lower()),
        (5, "Question: Which river flows through the old town of Dresden"),
        (6, CLEAN + "3 1 4 1 5 9 2 7 and 12 and 30"),
    ]
    assert query_leaks(spark, tmp_path, docs, items) == {(i, i) for i in range(1, 6)}
