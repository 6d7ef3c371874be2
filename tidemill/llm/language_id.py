"""Language of web pages: text, declared language, address and host, fused by Bayes' rule.

1. Text. Byte trigrams of all labelled documents are counted per language (grouped aggregation over a fixed number
   of hash buckets); a page's visible text gets a log likelihood per language, tempered, as
   trigrams of a text are not independent.
2. Declared language and address suffix. How often each is seen with each language, by the text's own posterior,
   is a grouped aggregation over all pages; it gives likelihoods with add-one smoothing.
3. Host. Languages are summed per host, per domain (last two names) and over all pages; a host's prior leans on its domain,
   the domain's on all pages, by ``LEAN`` pseudo-pages each. A page's own share is left out of its prior.
4. The posterior is the product of the four, and the language with the most of it is the answer.

Counts are partial sums; the tables joined back are one row per host, domain, suffix or declared tag, and hosts
with very many pages are split by adaptive skew joins.

Defined results: null or empty pages have no text evidence; null addresses and missing tags are values of their own;
pages are read whole; every row gives a row, repeated ones and those without ``page_id``
included. Documents without language or text teach nothing; with no labelled documents the
language is null. An empty page table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemill.llm.common import stored, table, text_of

BUCKETS = 1 << 15
#: Weight of a trigram's log likelihood, and most evidence in favour that a text may give, in nats.
TEMPER, MOST = 0.1, 20.0
LEAN = 5.0
#: Share of all pages from which a host, suffix or tag is taken out of the shuffle; at most one in so many can have it.
HEAVY = 0.01
CHUNK = 1 << 20
#: Languages that the text model knows at most, those with most documents: its size is no matter of the input.
MODELLED = 256
OPENS = re.compile(r"(?i)<!--|<(script|style|nav|noscript)\b")
CLOSES = {"": re.compile("-->")} | {name: re.compile(rf"(?i)</{name}\s*>") for name in ("script", "style", "nav", "noscript")}
TAG = re.compile(r"<[^>]*>")


def visible_text(page: str) -> str:
    """The page without scripts, styles, menus, comments and tags.

    What has no end is left in. Every sign is passed over a few times at most, whatever is left open: an
    end that was looked for once and is not there is not looked for again.
    """
    parts, at, kept, endless = [], 0, 0, set()
    while opened := OPENS.search(page, at):
        name = (opened[1] or "").lower()
        closed = None if name in endless else CLOSES[name].search(page, opened.end())
        if closed:
            parts += [page[kept : opened.start()], " "]
            at = kept = closed.end()
        else:
            endless.add(name)
            at = opened.start() + 1
    seen = "".join([*parts, page[kept:]])
    last = seen.rfind(">") + 1  # behind it no tag ends
    return html.unescape(TAG.sub(" ", seen[:last]) + seen[last:])


def trigrams(text: str) -> np.ndarray:
    """Hash bucket of each byte trigram of the lower-case letters and blanks of a text."""
    codes = np.frombuffer(re.sub(r"[\W\d_]+", " ", text.lower()).encode(), np.uint8).astype(np.uint32)
    return ((codes[:-2] << 16 | codes[1:-1] << 8 | codes[2:]) * np.uint32(2654435761)) >> np.uint32(17)


def trigram_counts(docs: DataFrame) -> DataFrame:
    """``lang, bucket, n`` over all documents with a language."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch["lang"], batch["text"], strict=True):
                for i in range(0, len(text), CHUNK):
                    t = trigrams(text[i : i + CHUNK])
                    if len(t):
                        own = sums.setdefault(lang, np.zeros(BUCKETS, np.int64))
                        own += np.bincount(t, minlength=BUCKETS)
        for lang, own in sums.items():
            seen = np.flatnonzero(own)
            yield pd.DataFrame({"lang": lang, "bucket": seen, "n": own[seen]})

    texts = docs.where("lang is not null and text is not null").select(F.col("lang").cast("string").alias("lang"), "text")
    return (
        texts.mapInPandas(count, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    )


def text_model(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages, and tempered log likelihood of each bucket: ``MODELLED`` x ``BUCKETS`` numbers at most."""
    lang = F.col("lang").cast("string").alias("lang")
    known = docs.where("lang is not null").groupBy(lang).agg(F.count("*").alias("n"))
    langs = [r["lang"] for r in known.orderBy(F.desc("n"), "lang").limit(MODELLED).collect()]
    counts = trigram_counts(docs.where(F.col("lang").cast("string").isin(langs))).toPandas()
    langs = sorted(counts["lang"].unique())
    n = np.ones((len(langs), BUCKETS))
    if langs:
        n[np.searchsorted(langs, counts["lang"]), counts["bucket"]] += counts["n"]
    return langs, (TEMPER * np.log(n / n.sum(axis=1, keepdims=True))).astype(np.float32)


def _log_posterior(logs: np.ndarray) -> np.ndarray:
    logs = np.maximum(logs - logs.max(), -MOST)
    return logs - np.log(np.exp(logs).sum())


def page_evidence(pages: DataFrame, langs: list[str], model: np.ndarray) -> DataFrame:
    """``page_id, host, domain, suffix, declared, text_logs`` of every page."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            logs = []
            for page in batch.pop("html"):
                t, total = visible_text(page), np.zeros(len(langs))
                for i in range(0, len(t), CHUNK):
                    total += model[:, trigrams(t[i : i + CHUNK])].sum(axis=1)
                logs.append(_log_posterior(total))
            yield batch.assign(text_logs=logs)

    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    opening = F.regexp_extract(text_of("html"), r"(?i)<html\b([^>]*)", 1)
    tag = F.lower(F.regexp_extract(opening, r"(?i)\blang\s*=\s*[\"']?([A-Za-z]+)", 1))
    named = pages.select("page_id", host.alias("host"), tag.alias("declared"), text_of("html").alias("html"))
    named = named.select(
        "page_id",
        "host",
        F.regexp_extract("host", r"([^.]+\.)?[^.]+$", 0).alias("domain"),
        F.regexp_extract("host", r"[^.]+$", 0).alias("suffix"),
        "declared",
        "html",
    )
    kind = dict(named.dtypes)["page_id"]
    return named.mapInPandas(
        read, f"page_id {kind}, host string, domain string, suffix string, declared string, text_logs array<double>"
    )


def _with_sums(pages: DataFrame, values: DataFrame, key: str, n_pages: int) -> DataFrame:
    """The pages with their value's sums. Values with a ``HEAVY`` share of all pages, which are few, meet their pages by a
    broadcast; pages of the others, a small share each, are shuffled to them."""
    frequent = F.col("pages") >= max(1.0, HEAVY * n_pages)
    heavy, light = values.where(frequent).drop("pages"), values.where(~frequent).drop("pages")
    often = pages.join(F.broadcast(heavy), key)
    seldom = pages.join(F.broadcast(heavy.select(key)), key, "left_anti").join(light, key)
    return often.unionByName(seldom)


def identify(spark: SparkSession, pages: DataFrame, docs: DataFrame) -> DataFrame:
    """``page_id, host, declared, text_lang, lang, confidence`` of every page."""
    langs, model = text_model(docs)
    if not langs:
        return pages.select("page_id").select(
            "page_id", *[F.lit(None).cast("string").alias(c) for c in ("host", "declared", "text_lang", "lang")],
            F.lit(None).cast("double").alias("confidence"),
        )
    n = len(langs)
    seen = stored(spark, page_evidence(pages, langs, model), "pages")

    def sums(by: str | None, name: str) -> DataFrame:
        parts = [F.sum(F.exp(F.col("text_logs")[i])) for i in range(n)]
        return (seen.groupBy(by) if by else seen.groupBy()).agg(F.array(*parts).alias(name), F.count("*").alias("pages"))

    def each(make) -> Column:
        return F.array(*[make(i) for i in range(n)])

    own = lambda i: F.exp(F.col("text_logs")[i])
    total = lambda name: sum((F.col(name)[i] for i in range(1, n)), F.col(name)[0])
    # How often a value comes with each language, smoothed: likelihoods for the declared tag and the suffix.
    overall, pages_seen = sums(None, "overall").first()
    tags = sums("declared", "by_tag")
    suffixes = sums("suffix", "by_suffix")
    hosts, domains = sums("host", "by_host"), sums("domain", "by_domain")
    joined = seen
    for key, values in (("host", hosts), ("domain", domains), ("suffix", suffixes), ("declared", tags)):
        joined = stored(spark, _with_sums(joined, values, key, pages_seen), key)
    joined = joined.withColumn("overall", F.array(*[F.lit(x or 0.0) for x in overall]))
    less = lambda name, i: F.greatest(F.col(name)[i] - own(i), F.lit(0.0))
    prior = joined.withColumn("p_all", each(lambda i: (less("overall", i) + 1) / (total("overall") - 1 + n)))
    prior = prior.withColumn(
        "p_domain", each(lambda i: (less("by_domain", i) + LEAN * F.col("p_all")[i]) / (total("by_domain") - 1 + LEAN))
    )
    prior = prior.withColumn(
        "p_host", each(lambda i: (less("by_host", i) + LEAN * F.col("p_domain")[i]) / (total("by_host") - 1 + LEAN))
    )
    given = lambda name, i: F.log((less(name, i) + 1) / (less("overall", i) + 2))
    fused = prior.withColumn(
        "logs",
        each(lambda i: F.col("text_logs")[i] + F.log(F.col("p_host")[i]) + given("by_tag", i) + given("by_suffix", i)),
    )
    names = F.array(*[F.lit(x) for x in langs])
    best = lambda column: F.element_at(names, F.array_position(F.col(column), F.array_max(column)).cast("int"))
    weight = sum((F.exp(F.col("logs")[i] - F.array_max("logs")) for i in range(1, n)), F.exp(F.col("logs")[0] - F.array_max("logs")))
    return fused.select(
        "page_id", "host", "declared", best("text_logs").alias("text_lang"), best("logs").alias("lang"), (1 / weight).alias("confidence")
    )


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(spark, table(spark, sf_dir, "pages"), table(spark, sf_dir, "documents"))


QUERIES = {"op6_language_id": op6_language_id}
ORACLES: dict[str, str] = {}
