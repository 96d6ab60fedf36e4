"""Language ID by Bayesian evidence fusion.

P(language | text, markup, address, host) is in proportion to P(text | language) P(declared | language) P(suffix | language)
P(language | host). The text likelihood is that of hashed byte trigrams, tempered because neighbouring trigrams are not
independent. What a page declares in its markup and the suffix of its address count as much as grouped counts over all
rows say they agree with texts, and the prior of a host is smoothed towards its domain's, that one towards the whole corpus.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import as_bytes, frugal, masked, store

LANGUAGES = ("de", "en", "es", "fr")
NONE = "und"
#: Bound on the labelled rows that the text model is fitted on, as the expected size of a hash-chosen sample.
MOST_LABELLED = 4000
BUCKETS = 1 << 16
#: A trigram counts as this share of an independent observation.
TEMPER = 0.1
#: Pseudo-rows with which a domain's or the corpus's distribution enters that of a host or domain.
SMOOTHING = 20.0
_AT_ONCE = 1 << 18
_FLOOR = 0.1  # share of the uniform distribution in a language's trigrams
_LOWER = np.frombuffer(bytes(range(256)).lower(), np.uint8).astype(np.uint32)


def trigram_buckets(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(buckets of all byte trigrams of all texts, how many each text has); A-Z lower-cased, a space added at both ends."""
    low = _LOWER[np.frombuffer(b"  ".join([b"", *texts, b""]), np.uint8)]
    code = (low[:-2] << np.uint32(16)) + (low[1:-1] << np.uint32(8)) + low[2:]
    bucket = (code * np.uint32(0x9E3779B1)) >> np.uint32(16)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    # a text's stretch has two trigrams too many: the first begins with both spaces before it, the last ends with both after it
    starts = np.cumsum(np.r_[0, sizes[:-1] + 2]) if len(sizes) else np.empty(0, np.int64)
    keep = np.ones(len(bucket), bool)
    keep[starts] = keep[starts + sizes + 1] = False
    return bucket[keep], sizes


def _gram_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, labels = as_bytes(batch.column(1)), batch.column(0).to_pylist()
        for label in sorted(set(labels)):
            own = [t for t, x in zip(texts, labels, strict=True) if x == label]
            counts = sum(np.bincount(trigram_buckets([own[k] for k in g])[0], minlength=BUCKETS) for g in _groups(own))
            found = np.flatnonzero(counts)
            n = counts[found]
            yield pa.RecordBatch.from_arrays([pa.array([label] * len(found), pa.string()), pa.array(found), pa.array(n)], ["lang", "bucket", "n"])


def fit_text_model(labelled: DataFrame, label: str = "lang", text: str = "text", id_col: str = "doc_id", languages: Sequence[str] = LANGUAGES, most: int = MOST_LABELLED) -> np.ndarray:
    """Log probabilities (bucket, language + 1) of trigrams; the last column, no known language, is uniform.

    Fitted on a sample of about `most` labelled rows at most, chosen by a hash of their ids. A language without labelled rows is uniform.
    """
    labelled = labelled.where(F.col(label).isin(*languages) & F.col(text).isNotNull())
    share = most / max(most, labelled.count())
    chosen = labelled.where(F.conv(F.substring(F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 1, 8), 16, 10).cast("double") < share * 2.0**32)
    grams = chosen.select(F.col(label).alias("lang"), F.col(text).alias("text")).mapInArrow(frugal(_gram_counts), "lang string, bucket long, n long")
    table = np.zeros((BUCKETS, len(languages) + 1))
    summed = grams.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()  # BUCKETS rows a language at most
    table[summed["bucket"].to_numpy(), [languages.index(x) for x in summed["lang"].to_pylist()]] = summed["n"].to_numpy()
    totals = table.sum(axis=0)
    share_of = np.where(totals > 0, table / np.maximum(totals, 1), 1 / BUCKETS)
    return np.log((1 - _FLOOR) * share_of + _FLOOR / BUCKETS).astype(np.float32)


def _groups(texts: list[bytes]) -> Iterator[list[int]]:
    """Numbers of texts that are looked at together: some hundred thousand bytes, or one long text."""
    group, size = [], 0
    for k, t in enumerate(texts):
        group.append(k)
        size += len(t)
        if size > _AT_ONCE:
            yield group
            group, size = [], 0
    if group:
        yield group


def text_evidence(texts: list[bytes], model: np.ndarray) -> np.ndarray:
    """Tempered log likelihoods (text, language + 1)."""
    out = np.zeros((len(texts), model.shape[1]))
    for group in _groups(texts):
        bucket, sizes = trigram_buckets([texts[k] for k in group])
        owner = np.repeat(np.array(group), sizes)
        for at in range(0, len(bucket), _AT_ONCE):
            own = owner[at : at + _AT_ONCE]
            first = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
            out[own[first]] += np.add.reduceat(model[bucket[at : at + _AT_ONCE]], first, axis=0, dtype=np.float64)
    return TEMPER * out


def _scored(model: np.ndarray, text_at: int, text_of: Callable[[bytes], bytes] | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = as_bytes(batch.column(text_at))
            found = text_evidence([text_of(t) for t in texts] if text_of else texts, model)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(list(found), pa.list_(pa.float64()))], [*batch.schema.names, "pw_text"])

    return run


def with_text_evidence(df: DataFrame, text_col: str, model: np.ndarray, text_of: Callable[[bytes], bytes] | None = None) -> DataFrame:
    """df with pw_text, the text evidence per language; text_of makes a text of the column's bytes (markup off a page)."""
    fields = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return df.mapInArrow(frugal(_scored(model, df.columns.index(text_col), text_of)), f"{fields}, pw_text array<double>")


def _names(languages: Sequence[str]) -> tuple[str, ...]:
    return (*languages, NONE)


def best(scores: Column, languages: Sequence[str]) -> Column:
    """Name of the largest score, of equal ones the first; `und` for a text without trigrams, of which every score is 0."""
    name = F.element_at(F.array(*[F.lit(x) for x in _names(languages)]), F.array_position(scores, F.array_max(scores)).cast("int"))
    return F.when((F.array_max(scores) == 0) & (F.array_min(scores) == 0), F.lit(NONE)).otherwise(name)


def _per_guess(languages: Sequence[str]) -> list[Column]:
    return [F.sum(F.when(F.col("guess") == x, F.col("n")).otherwise(0)).cast("double").alias(f"n_{k}") for k, x in enumerate(_names(languages))]


def priors(guesses: DataFrame, languages: Sequence[str] = LANGUAGES) -> DataFrame:
    """host, domain, prior (log, per language) from guesses(guess, host, domain, n): a host's counts smoothed by its domain's, those by all rows'."""
    ks = range(len(_names(languages)))
    by_host = store(guesses.groupBy("domain", "host").agg(*_per_guess(languages)), "language_hosts")
    sums = [F.sum(f"n_{k}").alias(f"n_{k}") for k in ks]
    whole = by_host.agg(*sums).first()  # one row
    n = [whole[f"n_{k}"] or 0.0 for k in ks]
    total = sum((F.col(f"n_{k}") for k in ks), F.lit(0.0))
    smoothed = [(F.col(f"n_{k}") + SMOOTHING * ((n[k] + 1) / (sum(n) + len(n)))) / (total + SMOOTHING) for k in ks]
    by_domain = store(by_host.groupBy("domain").agg(*sums).select(F.col("domain").alias("of_domain"), *[c.alias(f"p_{k}") for k, c in enumerate(smoothed)]), "language_domains")
    prior = F.array(*[F.log((F.col(f"n_{k}") + SMOOTHING * F.col(f"p_{k}")) / (total + SMOOTHING)) for k in ks])
    return by_host.join(by_domain, F.col("domain").eqNullSafe(F.col("of_domain"))).select("host", "domain", prior.alias("weight"))


def reliability(guesses: DataFrame, sign: str, languages: Sequence[str] = LANGUAGES) -> DataFrame:
    """value, weight (log P(value | language), per language) of a sign such as the declared language; null is a value too."""
    ks = range(len(_names(languages)))
    per = store(guesses.groupBy(F.col(sign).alias("value")).agg(*_per_guess(languages)), f"language_{sign}")
    whole = per.agg(F.count("*").alias("kinds"), *[F.sum(f"n_{k}").alias(f"n_{k}") for k in ks]).first()  # one row
    return per.select("value", F.array(*[F.log((F.col(f"n_{k}") + 1) / ((whole[f"n_{k}"] or 0.0) + whole["kinds"])) for k in ks]).alias("weight"))


def fuse(scored: DataFrame, host: Column, domain: Column, signs: dict[str, Column] | None = None, languages: Sequence[str] = LANGUAGES) -> DataFrame:
    """scored, as with_text_evidence() gives it, with text_lang, lang and posterior (the probability of lang).

    Host, domain and signs may be null, a value like any other. A row without text is und, with posterior 1. Columns whose names begin
    with pw_ must not occur but for pw_text, which the result no longer has.
    """
    signs = signs or {}
    at = {"host": host, "domain": domain, **signs}
    guesses = store(scored.select(best(F.col("pw_text"), languages).alias("guess"), *[c.cast("string").alias(k) for k, c in at.items()]).groupBy("guess", *at).agg(F.count("*").alias("n")), "language_guesses")
    out = scored.withColumns({f"pw_{k}": c.cast("string") for k, c in at.items()})
    tables = {"prior": (store(priors(guesses, languages), "language_priors"), ["host", "domain"])}
    tables |= {k: (store(reliability(guesses, k, languages).withColumnRenamed("value", k), "language_signs"), [k]) for k in signs}
    evidence = F.col("pw_text")
    for name, (table, keys) in tables.items():
        table = table.select(*[F.col(k).alias(f"pw_{name}_{k}") for k in keys], F.col("weight").alias(f"pw_{name}_weight"))
        same = [F.col(f"pw_{k}").eqNullSafe(F.col(f"pw_{name}_{k}")) for k in keys]
        out = out.join(table, same[0] & same[1] if same[1:] else same[0], "left")
        evidence = F.zip_with(evidence, F.col(f"pw_{name}_weight"), lambda a, b: a + b)
    out = out.withColumn("pw_all", evidence)
    text_lang = best(F.col("pw_text"), languages)
    top = F.array_max("pw_all")
    share = 1 / F.aggregate(F.transform("pw_all", lambda x: F.exp(x - F.array_max("pw_all"))), F.lit(0.0), lambda a, x: a + x)
    empty = text_lang.eqNullSafe(F.lit(NONE)) & (F.array_min("pw_text") == 0)
    lang = F.when(empty, F.lit(NONE)).otherwise(F.element_at(F.array(*[F.lit(x) for x in _names(languages)]), F.array_position("pw_all", top).cast("int")))
    kept = [c for c in scored.columns if c != "pw_text"]
    return out.select(*kept, text_lang.alias("text_lang"), lang.alias("lang_id"), F.when(empty, F.lit(1.0)).otherwise(share).alias("posterior"))


#: What a text or page says its language is, and the suffix of the first address in a text. Neither looks at a character many times.
_DECLARED = r"(?i)<[a-z]+\b[^<>]*?\s(?:xml:)?lang\s*=\s*[\"']?([a-z]{2,3})"
_ADDRESS = r"(?:@|://)[A-Za-z0-9.-]*\.([A-Za-z]{2,})"


def _nothing(c: Column) -> Column:
    return F.when(c != "", c)


def _document_signs(source: Column, text: Column) -> tuple[Column, Column, dict[str, Column]]:
    """(host, domain, signs) of a document: its source is the host; declared: what markup in it says; suffix: that of its source, if
    that is a host's name, else of the first address in it. What a document doesn't have is null, which is evidence as any value."""
    named = F.contains(source, F.lit("."))
    suffix = F.when(named, F.lower(F.substring_index(source, ".", -1))).otherwise(_nothing(F.lower(F.regexp_extract(text, _ADDRESS, 1))))
    return source, F.when(named, F.lower(F.substring_index(source, ".", -2))), {"declared_as": _nothing(F.lower(F.regexp_extract(text, _DECLARED, 1))), "suffix": suffix}


def document_languages(docs: DataFrame, languages: Sequence[str] = LANGUAGES) -> DataFrame:
    """doc_id, lang_id, posterior, text_lang, kept for every row of documents.

    `lang` labels the sample that the text model is fitted on and is no evidence; what is, see _document_signs. A document is rejected,
    kept = false, if none of the languages explains it better than noise does, or it has no text. Rows that repeat count again and have
    equal results; of equal posteriors the first language in order wins. An empty table gives an empty result.
    """
    model = fit_text_model(docs, languages=languages)
    host, domain, signs = _document_signs(F.col("source"), F.col("text"))
    slim = docs.select("doc_id", host.alias("host"), domain.alias("domain"), *[c.alias(k) for k, c in signs.items()], "text")
    scored = store(with_text_evidence(slim, "text", model).drop("text"), "language_texts")
    found = fuse(scored, F.col("host"), F.col("domain"), {k: F.col(k) for k in signs}, languages)
    return found.select("doc_id", "lang_id", "posterior", "text_lang", (F.col("lang_id") != NONE).alias("kept"))


def keep_known(docs: DataFrame, languages: Sequence[str] = LANGUAGES) -> DataFrame:
    """docs without the documents that document_languages() rejects."""
    plain, names = masked(docs)
    host, domain, signs = _document_signs(F.col(names["source"]), F.col(names["text"]))
    known = plain.withColumns({"host": host, "domain": domain, **signs})  # looked for in the text once
    scored = with_text_evidence(known, names["text"], fit_text_model(docs, languages=languages))
    return fuse(scored, F.col("host"), F.col("domain"), {k: F.col(k) for k in signs}, languages).where(F.col("lang_id") != NONE).select(plain.columns).toDF(*docs.columns)


_MARKUP = re.compile(rb"<(?:(script|style)\b|(!--))|<[^<>]*>?|&[a-z#0-9]+;?", re.I)
_REST = re.compile(rb"[^<>]*>?")
_ENDS = {b"script": re.compile(rb"</script\s*>", re.I), b"style": re.compile(rb"</style\s*>", re.I), b"!--": re.compile(rb"-->")}


def _off_markup(html: bytes) -> bytes:
    """Text without tags, scripts, styles, comments and references, in one pass: what has no end is looked for once."""
    out, at, endless = [], 0, set()
    while m := _MARKUP.search(html, at):
        out.append(html[at : m.start()])
        at, kind = m.end(), (m[1] or m[2] or b"").lower()
        if kind and kind not in endless:
            end = _ENDS[kind].search(html, at)
            if end:
                at = end.end()
            else:
                endless.add(kind)
        if kind in endless:
            at = _REST.match(html, at).end()
    out.append(html[at:])
    return b" ".join(b" ".join(out).split())


def page_languages(pages: DataFrame, labelled: DataFrame, languages: Sequence[str] = LANGUAGES) -> DataFrame:
    """page_id, lang_id, posterior, text_lang, declared, host for every row of pages.

    The text model is fitted on labelled(doc_id, lang, text); declared is the lang attribute of the html element, the suffix
    the last label of the host, the domain its last two. A null url has no host, a null html no text: und. Rows that repeat have equal
    results; an empty table gives an empty result.
    """
    model = fit_text_model(labelled, languages=languages)
    declared = _nothing(F.lower(F.regexp_extract("html", r"(?is)<html\b[^<>]*?\slang\s*=\s*[\"']?([a-z]{2,3})", 1)))
    host = _nothing(F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1)))
    slim = pages.select("page_id", host.alias("host"), declared.alias("declared"), "html")
    scored = store(with_text_evidence(slim, "html", model, _off_markup).drop("html"), "language_pages")
    suffix, domain = F.substring_index("host", ".", -1), F.substring_index("host", ".", -2)
    found = fuse(scored, F.col("host"), domain, {"declared_as": F.col("declared"), "suffix": suffix}, languages)
    return found.select("page_id", "lang_id", "posterior", "text_lang", "declared", "host")
