import random

import pytest

from tidemill.llm import decontaminate
from tidemill.llm.decontaminate import Items, distances, find_leaks, is_leaked, nearest, normal, without_leaks


def edit_table(pattern, text, free):
    row = [0 if free else j for j in range(len(text) + 1)]
    for i, p in enumerate(pattern, 1):
        new = [i]
        for j, c in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (p != c)))
        row = new
    return row


def test_distances_match_the_table():
    random.seed(0)
    for _ in range(200):
        p, t = ("".join(random.choice("abc ") for _ in range(random.randint(1, n))) for n in (9, 15))
        for free in (True, False):
            assert distances(p, t, free) == edit_table(p, t, free)


def test_nearest_gives_the_stretch():
    assert nearest("hello world", "xx helo world yy", 2) == (1, 3, 13)
    assert nearest("hello world", "nothing like it", 2) is None


VOCABULARY = ["".join(random.Random(i).choice("abcdefghij") for _ in range(3 + i % 6)) for i in range(300)]


def prose(rng, n):
    return " ".join(rng.choice(VOCABULARY) for _ in range(n))


def edited(rng, text, edits):
    chars = list(text)
    for _ in range(edits):
        at, kind = rng.randrange(len(chars)), rng.randrange(3)
        if kind == 0:
            chars[at] = rng.choice("abcdefghij")
        elif kind == 1:
            del chars[at]
        else:
            chars.insert(at, rng.choice("abcdefghij"))
    return "".join(chars)


def test_recall_on_edited_copies():
    rng = random.Random(5)
    texts = [prose(rng, rng.randint(20, 60)) for _ in range(60)]
    items = Items(list(enumerate(texts)), 0.1)
    docs, truth = [], []
    for k in range(300):
        i = k % 60
        copy = edited(rng, texts[i], int(rng.choice([0, 0.02, 0.05, 0.08]) * len(texts[i])))
        docs.append(prose(rng, 150) + " " + copy.upper() + "\n" + prose(rng, 150))
        truth.append(i)
    found = [{leak[0] for leak in leaks} for leaks in items.leaks(docs)]
    assert sum(i in f for i, f in zip(truth, found, strict=True)) >= 0.95 * len(docs)
    assert sum(len(f - {i}) for i, f in zip(truth, found, strict=True)) == 0
    assert all(not leaks for leaks in items.leaks([prose(rng, 300) for _ in range(50)]))


def test_reported_edits_are_exact():
    rng = random.Random(9)
    texts = [prose(rng, 30) for _ in range(20)]
    docs = [prose(rng, 40) + " " + edited(rng, t, 4) + " " + prose(rng, 40) for t in texts]
    for i, leaks in enumerate(Items(list(enumerate(texts)), 0.1).leaks(docs)):
        for item, edits, size, start, end in leaks:
            assert item == i and size == len(texts[i])
            assert edits == min(edit_table(normal(texts[i]), normal(docs[i]), True))
            assert edit_table(texts[i], normal(docs[i])[start:end], False)[-1] == edits


@pytest.mark.parametrize("block", [8 << 20, 60])
def test_odd_tables(spark, odd_docs, no_docs, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", block)
    rows = [(1, "three four five"), (1, "three four five"), (2, None), (3, ""), (4, "  "), (None, "very LONG\ntext. many words in one very long text. many")]
    bench = spark.createDataFrame([(i, t, 0) for i, t in rows], "item_id long, text string, doc_id long")
    got = sorted(((r["doc_id"], r["item_id"], r["edits"]) for r in find_leaks(odd_docs, bench).collect()), key=repr)
    assert got == sorted([(d, 1, 0) for d in (1, 1, 1, 1, 7, 7)] + [(5, None, 0), (6, None, 0)], key=repr)
    left = odd_docs.where(~is_leaked(bench))
    assert sorted(str(r["doc_id"]) for r in left.collect()) == sorted(map(str, [2, 3, 4, None, None, 8, 9]))
    assert find_leaks(no_docs, bench).collect() == find_leaks(odd_docs, bench.limit(0)).collect() == []
    assert odd_docs.where(~is_leaked(bench.limit(0))).count() == odd_docs.count()


@pytest.mark.parametrize(("size", "rate", "least"), [(60, 0, 1.0), (100, 0, 1.0), (150, 0, 1.0), (100, 0.05, 0.95), (150, 0.08, 0.95)])
def test_recall_in_text_without_blanks(size, rate, least):
    rng = random.Random(size)
    text = lambda n: "".join(chr(rng.randrange(0x4E00, 0x9FA0)) for _ in range(n))
    texts = [text(size) for _ in range(100)]
    docs = [text(5 + i) + edited(rng, t, int(rate * size)) + text(100) for i, t in enumerate(texts)]
    found = [[leak[0] for leak in leaks] for leaks in Items(list(enumerate(texts)), 0.1).leaks(docs)]
    assert sum(f == [i] for i, f in enumerate(found)) >= least * len(docs)
    assert all(f in ([], [i]) for i, f in enumerate(found))


def best_bounded(item, text, limit):
    found = [
        edits
        for a in range(len(text))
        if not decontaminate._inside_word(text, a)
        for n, edits in enumerate(edit_table(item, text[a : a + len(item) + limit], False))
        if n and edits <= limit and not decontaminate._inside_word(text, a + n)
    ]
    return min(found, default=None)


def test_edited_copies_of_short_items():
    rng = random.Random(2)
    texts = [prose(rng, 12)[:n].strip() for n in range(10, 48) for _ in range(2)]
    items = Items(list(enumerate(texts)), 0.1)
    docs = [prose(rng, 5) + " " + edited(rng, t, int(0.1 * len(t))) + " " + prose(rng, 5) for t in texts]
    for i, leaks in enumerate(items.leaks(docs)):
        got = {leak[0]: leak[1] for leak in leaks}
        assert got.get(i) == best_bounded(texts[i], normal(docs[i]), items.limits[i])


@pytest.mark.parametrize(
    ("item", "text", "edits"),
    [
        ("which city is the capital", "so which  city is the capital, then", 1),
        ("which city is the capital", "so which city is the capitals", 1),
        ("the tree", "see the trees", None),
        ("法国的首都是哪一座城市", "请问法国的首都是哪一座城市呢", 0),
        ("法国的首都是哪一座城市", "请问法国的首都在哪一座城市呢", 1),
        ("capital of france", "答えはcapital of franceです", 0),
        ("法国首都", "请问法国首都呢", 0),
    ],
)
def test_short_items(item, text, edits):
    (leaks,) = Items([(1, item)], 0.1).leaks([text])
    assert [leak[1] for leak in leaks] == ([] if edits is None else [edits])


def test_items_with_a_common_opening_cost_in_proportion():
    from time import process_time

    stem = "which of the following statements about the history of "
    rng = random.Random(4)
    texts = [stem + prose(rng, 12) for _ in range(800)]
    docs = [" ".join(rng.sample(texts, 20)) + " " + " ".join(stem + prose(rng, 12) for _ in range(20)) for _ in range(6)]
    taken = {}
    for n in (200, 800):
        items = Items(list(enumerate(texts[:n])), 0.1)
        begin = process_time()
        found = [{leak[0] for leak in leaks} for leaks in items.leaks(docs)]
        taken[n] = process_time() - begin
        for doc, got in zip(docs, found, strict=True):
            assert {i for i, t in enumerate(texts[:n]) if normal(t) in normal(doc)} <= got
    assert taken[800] < 2.5 * taken[200] + 0.5


def test_repetitions_follow_the_target_recall():
    rng = random.Random(11)
    texts = [prose(rng, rng.randint(12, 60)) for _ in range(150)]
    copies = [edited(rng, t, int(0.1 * len(t))) for t in texts]
    recall, repeats = {}, {}
    for target in (0.5, 0.99):
        items = Items(list(enumerate(texts)), 0.1, target)
        repeats[target] = len(items.windows)
        docs = [prose(rng, 20) + " " + c + " " + prose(rng, 20) for c in copies]
        recall[target] = sum(i in {leak[0] for leak in leaks} for i, leaks in enumerate(items.leaks(docs))) / len(docs)
    assert repeats[0.5] <= repeats[0.99] <= decontaminate.MOST_REPEATS
    assert recall[0.99] >= 0.97 and recall[0.99] >= recall[0.5] >= 0.5


def test_blocks_of_items_are_passes_of_their_own(spark, odd_docs, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", 60)
    rows = [(1, "three four five"), (2, "no id at all"), (3, "very LONG text. many words in one very long text. many")]
    bench = spark.createDataFrame(rows, "item_id long, text string")
    left = without_leaks(spark, odd_docs, bench)
    assert left.columns == odd_docs.columns
    assert sorted(str(r["doc_id"]) for r in left.collect()) == sorted(map(str, [2, 3, 4, None, 8, 9]))
    assert without_leaks(spark, odd_docs, bench.limit(0)).count() == odd_docs.count()


def test_long_items_equal_a_search_of_all_pairs():
    """Every item against every document by edit distance alone: nothing else is found, and what is found is the best."""
    rng = random.Random(21)
    texts = [prose(rng, rng.randint(10, 40)) for _ in range(40)]
    docs = []
    for _ in range(120):
        parts = [prose(rng, rng.randint(0, 60))]
        for i in rng.sample(range(40), rng.choice([0, 1, 2])):
            parts += [edited(rng, texts[i], int(rng.choice([0, 0.04, 0.09, 0.1, 0.12, 0.2]) * len(texts[i]))), prose(rng, 20)]
        docs.append(" ".join(parts))
    items = Items(list(enumerate(texts)), 0.1)
    want, got = {}, {}
    for d, leaks in enumerate(items.leaks(docs)):
        got |= {(d, i): edits for i, edits, *_ in leaks}
        low = normal(docs[d])
        for i, t in enumerate(items.texts):
            edits = min(distances(t, low, True))
            if edits <= items.limits[i]:
                want[d, i] = edits
    assert len(want) > 60
    assert all(want.get(pair) == edits for pair, edits in got.items())
    assert len(got) >= 0.97 * len(want)
