"""Language identification: text likelihoods fused with declared language, address suffix and host priors."""

from __future__ import annotations

import re
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from etlkit.llm.common import LOWER, added_up, array_rows, columns_of, slices, staged

GRAMS = 1 << 14  # hashed byte trigrams
INDEPENDENT = 60  # trigrams of a text count as at most this many independent observations
HOST_WEIGHT = 5.0  # pages of the level above that a host's (or domain's) prior is worth
UNKNOWN = "und"
LEAST_CONFIDENCE = 0.4

_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_MARKUP = re.compile(r"<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->|<[^>]*>", re.S | re.I)


def trigrams(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashed trigram, text index) of lower-cased bytes, for trigrams inside a text that hold a letter."""
    x = LOWER[data].astype(np.uint32)
    if len(x) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    letter = _LETTER[data].astype(np.int8)
    code = ((x[:-2] << 16 | x[1:-1] << 8 | x[2:]) * np.uint32(2654435761)) >> np.uint32(18)
    of = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
    keep = (of[:-2] == of[2:]) & (letter[:-2] + letter[1:-1] + letter[2:] >= 1)
    return code[keep].astype(np.int64), of[:-2][keep]


def train(labelled: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages of the labelled texts (text, lang), and log P(trigram | language), from the counts over all of them."""
    labelled = columns_of(labelled, "text", "lang").where(F.trim("lang") != "")
    languages = sorted(r[0] for r in labelled.select("lang").distinct().collect())
    if not languages:
        return [], np.zeros((0, GRAMS))
    number = {l: i for i, l in enumerate(languages)}

    def each(batches):
        counts = np.zeros((len(number), GRAMS))
        for rows, data, ends in slices(batches):
            code, of = trigrams(data, ends)
            lang = np.array([number[l] for l in rows.column("lang").to_pylist()])
            counts += np.bincount(lang[of] * GRAMS + code, minlength=counts.size).reshape(counts.shape)
        yield array_rows({0: counts})

    (counts,) = added_up(labelled.mapInArrow(each, "part int, data binary"), [(len(languages), GRAMS)], "trigrams")
    counts += 0.5
    return languages, np.log(counts / counts.sum(1, keepdims=True))


def likelihoods(rows: DataFrame, model: np.ndarray, html: bool) -> DataFrame:
    """`rows` without text, with n (trigrams), ll (log likelihood per language of at most INDEPENDENT trigrams' worth)
    and q (the posterior from the text alone, languages being equally likely before)."""
    carried = [f for f in rows.schema if f.name != "text"]

    def plain(batches):
        for batch in batches:
            if not html:
                yield batch
                continue
            texts = [unescape(_MARKUP.sub(" ", t)) if t else "" for t in batch.column("text").to_pylist()]
            at = batch.schema.get_field_index("text")
            yield batch.set_column(at, "text", pa.array([t.encode("utf-8", "replace").decode() for t in texts], pa.large_string()))

    def each(batches):
        for batch, data, ends in slices(plain(batches)):
            code, of = trigrams(data, ends)
            n = np.bincount(of, minlength=batch.num_rows)
            weight = np.minimum(n, INDEPENDENT) / np.maximum(n, 1)
            ll = np.stack([np.bincount(of, m[code], batch.num_rows) * weight for m in model], axis=1) if len(model) else np.zeros((batch.num_rows, 0))
            q = np.exp(ll - ll.max(1, keepdims=True)) if len(model) else ll
            q /= q.sum(1, keepdims=True) if len(model) else 1
            listed = lambda x: pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32()), pa.array(x.ravel(), pa.float64()))
            yield pa.RecordBatch.from_arrays([*[batch.column(f.name) for f in carried], pa.array(n, pa.int64()), listed(ll), listed(q)], [*[f.name for f in carried], "n", "ll", "q"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in carried)
    return rows.mapInArrow(each, f"{schema}, n long, ll array<double>, q array<double>")


def page_evidence(pages: DataFrame) -> list[Column]:
    """host, domain, suffix and declared language of pages (url, html)."""
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    some = lambda c: F.when(c != "", c)
    return [some(host).alias("host"), some(F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1)).alias("domain"), some(F.regexp_extract(host, r"\.([a-z]+)$", 1)).alias("suffix"),
            some(F.lower(F.regexp_extract(F.coalesce("html", F.lit("")), r"(?i)<html\b[^>]*\blang\s*=\s*[\"']?([a-zA-Z]+)", 1))).alias("declared")]


def fuse(scored: DataFrame, languages: list[str]) -> DataFrame:
    """Adds lang, confidence and kept to rows with host, domain, suffix, declared, n, ll, q.

    The posteriors from texts alone are summed per host, domain and overall by grouped aggregation. A row's prior is
    its host's share, smoothed with the domain's, which is smoothed with the overall one, without the row itself. What
    a declared language or a suffix says comes from how often each goes with each language; if absent, it says
    nothing. Rows whose text has no trigram of letters, or whose best language stays below LEAST_CONFIDENCE, are 'und'
    and not kept.
    """
    if not languages:
        return scored.withColumns({"lang": F.lit(UNKNOWN), "confidence": F.lit(0.0), "kept": F.lit(False)}).drop("ll", "q", "n", "host", "domain", "suffix", "declared")
    k = len(languages)
    own = [F.when(F.col("n") > 0, F.get("q", F.lit(i))).otherwise(0.0) for i in range(k)]
    whole = np.array([x or 0.0 for x in scored.agg(*[F.sum(x) for x in own]).first()])
    out = scored
    for key, name in (("host", "_h"), ("domain", "_d"), ("declared", "_c"), ("suffix", "_s")):
        sums = scored.where(F.col(key).isNotNull()).groupBy(key).agg(F.array(*[F.sum(x) for x in own]).alias(name))
        out = out.join(sums, key, "left")
    carried = [f for f in scored.schema if f.name not in ("ll", "q", "n", "host", "domain", "suffix", "declared")]

    def rows_of(column) -> tuple[np.ndarray, np.ndarray]:
        """Values per language, zero where NULL, and where there are some."""
        there = np.asarray(column.is_valid())
        values = np.zeros((len(column), k))
        values[there] = np.asarray(column.drop_null().flatten(), float).reshape(-1, k)
        return values, there[:, None]

    def each(batches):
        for batch in batches:
            n = np.asarray(batch.column("n"))
            ll, _ = rows_of(batch.column("ll"))
            q = rows_of(batch.column("q"))[0] * (n > 0)[:, None]
            prior = np.broadcast_to((whole + 1) / (whole.sum() + k), ll.shape)
            for name in ("_d", "_h"):
                total, there = rows_of(batch.column(name))
                rest = np.maximum(total - q * there, 0)
                prior = (rest + HOST_WEIGHT * prior) / (rest.sum(1, keepdims=True) + HOST_WEIGHT)
            score = ll + np.log(prior)
            for name in ("_c", "_s"):
                total, there = rows_of(batch.column(name))
                score += np.where(there, np.log((total + 0.5) / (whole + 1)), 0)
            best = score.argmax(1) if len(score) else np.zeros(0, int)
            sure = 1 / np.exp(score - score.max(1, keepdims=True)).sum(1) if len(score) else np.zeros(0)
            kept = (n > 0) & (sure >= LEAST_CONFIDENCE)
            lang = [languages[b] if ok else UNKNOWN for b, ok in zip(best, kept)]
            yield pa.RecordBatch.from_arrays([*[batch.column(f.name) for f in carried], pa.array(lang, pa.string()), pa.array(sure), pa.array(kept)],
                                             [*[f.name for f in carried], "lang", "confidence", "kept"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in carried)
    return out.select(*[f.name for f in carried], "n", "ll", "q", "_h", "_d", "_c", "_s").mapInArrow(each, f"{schema}, lang string, confidence double, kept boolean")


def identify_pages(pages: DataFrame, languages: list[str], model: np.ndarray) -> DataFrame:
    """page_id, lang, confidence, kept of pages (page_id, url, html); the text is what stands outside tags."""
    rows = columns_of(pages, "page_id", "url", "html").select("page_id", *page_evidence(pages), F.col("html").alias("text"))
    return fuse(staged(likelihoods(rows, model, html=True), "page-likelihoods"), languages).select("page_id", "lang", "confidence", "kept")


def identify_documents(docs: DataFrame, languages: list[str], model: np.ndarray) -> DataFrame:
    """doc_id, lang, confidence, kept of documents (doc_id, text, source): plain texts whose host is their source.

    NULL and empty texts, and texts without letters, are 'und' and not kept. Their own `lang` is no evidence. Rows that
    share a doc_id get a row each; an empty table gives no rows; other columns are ignored.
    """
    no = F.lit(None).cast("string")
    rows = columns_of(docs, "doc_id", "text", "source").select("doc_id", "text", F.col("source").cast("string").alias("host"), no.alias("domain"), no.alias("suffix"), no.alias("declared"))
    return fuse(staged(likelihoods(rows, model, html=False), "text-likelihoods"), languages).select("doc_id", "lang", "confidence", "kept")
