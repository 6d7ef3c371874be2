import math
import random

import pytest

from tidemill.llm import language_id
from tidemill.llm.language_id import LEAN, identify, op6_language_id, page_evidence, text_model, visible_text

WORDS = {"en": "the of and to in is that it was for", "de": "der die und in den von zu das mit sich", "fr": "le de un être et à il avoir ne je"}


def text(lang, n):
    own = WORDS[lang].split()
    return " ".join(own[(i * 7 + i // 3) % 10] for i in range(n))


def docs(spark):
    rows = [(i, text(lang, 80), lang) for i in range(30) for lang in WORDS] + [(99, None, "en"), (98, "x y", None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def page(lang, tag, n=60):
    return f'<!doctype html><html {f"lang={tag!r}" if tag else ""}><script>der die das</script><body><p>{text(lang, n) if lang else ""}</p></body></html>'


def run(spark, rows):
    return {r["page_id"]: r for r in identify(spark, spark.createDataFrame(rows, "page_id long, url string, html string"), docs(spark)).collect()}


def test_visible_text():
    assert visible_text("<style>x</style><!-- y --><nav>menu</nav><p>a&amp;b</p>").split() == ["a&b"]


def test_text_decides_against_a_wrong_tag(spark):
    rows = [(i, f"https://h{i % 3}.example.org/{i}", page(lang, lang)) for i, lang in enumerate(list(WORDS) * 10)]
    rows.append((100, "https://h0.example.org/x", page("fr", "de")))
    got = run(spark, rows)
    assert got[100]["lang"] == "fr"
    assert all(got[i]["lang"] == lang for i, lang in enumerate(list(WORDS) * 10))
    assert all(0 < r["confidence"] <= 1 for r in got.values())


def test_without_text_host_suffix_and_tag_decide(spark):
    rows = [(i, f"https://www.site{i % 4}.de/{i}", page("de", "de")) for i in range(40)]
    rows += [(40 + i, f"https://www.site{i % 4}.fr/{i}", page("fr", "fr")) for i in range(40)]
    rows += [(100, "https://www.site1.de/e", page(None, "")), (101, "https://www.new.fr/e", page(None, "")), (102, None, page(None, "fr"))]
    got = run(spark, rows)
    assert (got[100]["lang"], got[101]["lang"], got[102]["lang"]) == ("de", "fr", "fr")


def test_odd_pages(spark):
    rows = [(1, None, None), (1, None, None), (None, "", ""), (2, "no address", "<p>"), (3, "https://a.b/", page("en", "EN-us", 5000))]
    df = spark.createDataFrame([(*r, "z", "z", "z") for r in rows], "page_id long, url string, html string, host string, lang string, logs string")
    out = identify(spark, df, docs(spark)).collect()
    assert sorted(str(r["page_id"]) for r in out) == ["1", "1", "2", "3", "None"]
    assert next(r for r in out if r["page_id"] == 3)["declared"] == "en"
    assert identify(spark, df.limit(0), docs(spark)).collect() == []
    assert {r["lang"] for r in identify(spark, df, docs(spark).limit(0)).collect()} == {None}


def test_given_pages(spark):
    rows = op6_language_id(spark, "/root/testdata/sf0.01").collect()
    assert len(rows) == 250
    assert sum(r["lang"] == r["declared"] for r in rows) >= 0.98 * len(rows)
    assert sum(r["text_lang"] == r["declared"] for r in rows) >= 0.9 * len(rows)


@pytest.mark.parametrize("open_end", ["<script>x ", "<!-- x ", "<nav ", "<style <b ", "< ", "<html "])
def test_pages_of_open_ends_take_linear_time(spark, open_end):
    from time import process_time

    taken = []
    for n in (100_000, 400_000):
        page = open_end * (n // len(open_end))
        begin = process_time()
        visible_text(page)
        taken.append(process_time() - begin)
    assert taken[1] < 12 * taken[0] + 0.2
    got = run(spark, [(1, "https://a.example.org/", "<html lang='fr'>" + page)])
    assert got[1]["declared"] == "fr"


def test_visible_text_keeps_what_has_no_end():
    assert visible_text("a<script>b</script>c<!-- d").split() == ["a", "c<!--", "d"]
    assert visible_text("<SCRIPT a='1'>x</script >y<style>z").split() == ["y", "z"]
    assert visible_text("<!-->a-->b").split() == ["b"]
    assert visible_text("1 < 2 <b>3</b> 4 <").split() == ["1", "3", "4", "<"]


def test_posterior_is_bayes_rule_by_hand(spark):
    """The same evidence, multiplied page by page in plain Python."""
    rng = random.Random(3)
    rows = []
    for i in range(60):
        lang = rng.choice(list(WORDS))
        host = f"https://{rng.choice('ab')}{rng.randrange(3)}.site{rng.randrange(4)}.{rng.choice(['de', 'fr', 'org'])}/{i}"
        rows.append((i, host, page(lang if rng.random() < 0.7 else None, rng.choice([lang, lang, "xx", ""]), rng.randint(0, 6))))
    pages, known = spark.createDataFrame(rows, "page_id long, url string, html string"), docs(spark)
    langs, model = text_model(known)
    seen = {r["page_id"]: r for r in page_evidence(pages, langs, model).collect()}
    n = len(langs)
    share = {i: [math.exp(x) for x in r["text_logs"]] for i, r in seen.items()}
    for r in identify(spark, pages, known).collect():
        i, own = r["page_id"], seen[r["page_id"]]
        less = lambda field, k: sum(share[j][k] for j, o in seen.items() if j != i and (field is None or o[field] == own[field]))
        total = lambda field: sum(less(field, k) for k in range(n))
        logs = []
        for k in range(n):
            everywhere = (less(None, k) + 1) / (total(None) + n)
            domain = (less("domain", k) + LEAN * everywhere) / (total("domain") + LEAN)
            host = (less("host", k) + LEAN * domain) / (total("host") + LEAN)
            given = sum(math.log((less(f, k) + 1) / (less(None, k) + 2)) for f in ("declared", "suffix"))
            logs.append(own["text_logs"][k] + math.log(host) + given)
        most = max(logs)
        assert r["lang"] == langs[logs.index(most)]
        assert abs(r["confidence"] - 1 / sum(math.exp(x - most) for x in logs)) < 1e-9


def test_the_model_knows_a_bounded_number_of_languages(spark, monkeypatch):
    monkeypatch.setattr(language_id, "MODELLED", 2)
    more = docs(spark).union(spark.createDataFrame([(1000 + i, text("en", 50), f"tag{i}") for i in range(40)], "doc_id long, text string, lang string"))
    langs, model = text_model(more)
    assert len(langs) == 2 and model.shape[0] == 2


def test_frequent_hosts_change_the_way_not_the_result(spark, monkeypatch):
    rng = random.Random(6)
    rows = [
        (i, f"https://{'hot' if rng.random() < 0.4 else f'h{i}'}.example.{rng.choice(['de', 'fr'])}/", page(rng.choice(list(WORDS)), rng.choice(["de", "fr", ""]), 5))
        for i in range(90)
    ]
    results = []
    for heavy in (0.01, 0.2, 2.0):
        monkeypatch.setattr(language_id, "HEAVY", heavy)
        results.append({i: (r["lang"], r["host"], round(r["confidence"], 9)) for i, r in run(spark, rows).items()})
    assert len(results[0]) == 90 and results[0] == results[1] == results[2]
