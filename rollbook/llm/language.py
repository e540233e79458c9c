"""Language identification by fusing evidence the Bayesian way.

    posterior(l) ~ P(text | l) * P(declared | l) * P(address | l) * prior of the host for l

* Text: hashed three-byte grams of the lower-cased letters; in how many documents of each
  declared language a gram occurs is counted over all documents (so that no long or
  repetitive document outweighs others). Neighbouring grams depend on each
  other, so the log likelihood is tempered to that of ``GRAMS`` grams at most. One more
  class, ``und``, holds that all grams are equally likely.
* Declared language (markup ``lang`` or a metadata field) and address suffix (a path
  segment, first host label or ending that is a language's code): how often each is given
  for documents whose text alone says ``l`` is counted over all documents and smoothed.
* Host: the languages that text alone gives the host's other documents, smoothed towards
  its domain, that towards its ending, that towards all documents. A document's own vote
  is taken out first.

Classes are the declared codes (two or three letters before any ``-`` or ``_``) of at least
``MIN_DOCS`` documents, however large the table; their number is that of the languages. A
rarer code has too few texts to count grams from, so nothing can say that it is wrong.

Nulls and empties: missing evidence says nothing (a null declared code, address or host). A
text without letters has no text evidence and is not kept, whatever is declared. Nor is one
whose best class is ``und`` or has a probability below ``MIN_PROBABILITY``, unless its own
declared language explains it better than ``und`` does, or is too rare to be a class. Where
no class is best, those two take the declared code (a code that is no class with the
probability of ``und``). Ties go to the first code in alphabetical order. Texts that declare
nothing are ``und`` if there is no class.
Every row gives one output row; repeated rows repeat it. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from rollbook.llm.shared import land, texts, tidy

PLACES, GRAMS = 1 << 13, 200
MIN_DOCS, MIN_PROBABILITY = 5, 0.5
#: Pseudo-counts with which a level of hosts leans on the one above it.
LEAN = 20.0
UNKNOWN, UNKNOWN_PRIOR = "und", 0.01
#: Prior of each language if nothing is known; share of votes given to chance.
CHANCE = 0.02

_LETTER = np.zeros(256, dtype=bool)
_LETTER[97:123] = _LETTER[128:] = True


def grams(text: str) -> np.ndarray:
    """Places of the three-byte grams of the letters; what stands between words is one space."""
    raw = np.frombuffer(f" {text} ".lower().encode("utf-8", "replace"), dtype=np.uint8)
    raw = np.where(_LETTER[raw], raw, 32).astype(np.uint32)
    raw = raw[np.concatenate(([True], (raw[1:] != 32) | (raw[:-1] != 32)))]
    if len(raw) < 3:
        return np.empty(0, dtype=np.int64)
    gram = raw[:-2] << 16 | raw[1:-1] << 8 | raw[2:]
    return (gram * np.uint32(2654435761) >> np.uint32(32 - 13)).astype(np.int64)


def code_of(declared: Column) -> Column:
    """The language part of a declared code, in lower case; null if there is none."""
    code = F.regexp_extract(F.lower(F.trim(declared)), r"^([a-z]{2,3})(?:[-_].*)?$", 1)
    return F.when(code != "", code)


def suffix_of(address: Column, codes: list[str]) -> Column:
    """The code that an address carries: first path segment, first host label, or ending."""
    host = F.lower(F.regexp_extract(address, r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*://)?([^/?#:]*)", 1))
    path = F.lower(F.regexp_extract(address, r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*://)?[^/?#]*/([^/?#]+)(?:[/?#]|$)", 1))
    labels = F.split(host, r"\.")
    many = F.size(labels) > 1
    found = [
        F.when(path.isin(codes), path),
        F.when(many & F.element_at(labels, 1).isin(codes), F.element_at(labels, 1)),
        F.when(many & F.element_at(labels, -1).isin(codes), F.element_at(labels, -1)),
    ]
    return F.coalesce(*found) if codes else F.lit(None).cast("string")


def _counter(codes: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        at = {c: i for i, c in enumerate(codes)}
        for batch in batches:
            for code, text in zip(batch["code"].to_pylist(), texts(batch["text"])):
                if code in at:
                    if at[code] not in total:
                        total[at[code]] = np.zeros(PLACES, dtype=np.int64)
                    total[at[code]][np.unique(grams(text))] += 1
        for lang, n in total.items():
            place = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(place), lang), pa.int32()), pa.array(place, pa.int32()), pa.array(n[place])],
                ["lang", "place", "n"],
            )

    return run


def fit(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """Codes, and the log frequency of each gram in each; last the unknown class. ``docs``:
    ``code``, ``text``."""
    counts = docs.where("code IS NOT NULL").groupBy("code").count()
    codes = sorted(r["code"] for r in counts.where(F.col("count") >= MIN_DOCS).collect())
    seen = np.zeros((len(codes), PLACES), dtype=np.float32)
    if codes:
        parts = docs.select("code", "text").mapInArrow(tidy(_counter(codes)), "lang int, place int, n bigint")
        summed = parts.groupBy("lang", "place").agg(F.sum("n").alias("n"))
        # A row is a language: PLACES numbers at most.
        for r in summed.groupBy("lang").agg(F.collect_list(F.struct("place", "n")).alias("found")).toLocalIterator():
            place, n = zip(*r["found"])
            seen[r["lang"], list(place)] = n
    seen += np.float32(0.01)
    log = np.log(seen / seen.sum(axis=1, keepdims=True, dtype=np.float64).astype(np.float32))
    return codes, np.vstack((log, np.full((1, PLACES), -np.log(PLACES), dtype=np.float32)))


def _log_likelihood(log: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Of a text of these grams in each class; a place is looked up once however often it occurs."""
    times = np.bincount(at, minlength=PLACES)
    place = np.flatnonzero(times)
    total = (log[place] * times[place, None].astype(np.float32)).sum(axis=0, dtype=np.float64)
    return total / (1 + len(at) / GRAMS)


def _likelihoods(log: np.ndarray):
    log = np.ascontiguousarray(log.T)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, sizes = [], []
            for text in texts(batch["text"]):
                at = grams(text)
                sizes.append(len(at))
                rows.append(_log_likelihood(log, at) if len(at) else np.zeros(log.shape[1]))
            names = [n for n in batch.schema.names if n != "text"]
            yield pa.RecordBatch.from_arrays(
                [*(batch[n] for n in names), pa.array(sizes, pa.int64()), pa.array(rows, pa.list_(pa.float64()))],
                [*names, "grams", "ll"],
            )

    return run


def _vote_table(docs: DataFrame, key: str, n: int) -> DataFrame:
    """Votes for the languages that a key has any for; the unknown class has none."""
    votes = docs.where(F.col(key).isNotNull() & (F.col("vote") < n)).groupBy(key, "vote").agg(F.count("*").alias("n"))
    return votes.groupBy(key).agg(F.collect_list(F.struct("vote", "n")).alias(f"{key}_votes"))


def _matrix(docs: DataFrame, column: str, codes: list[str]) -> np.ndarray:
    """P(what ``column`` says | language), one column per code and one for any other."""
    at = {c: i for i, c in enumerate(codes)}
    seen = np.full((len(codes) + 1, len(codes) + 1), 0.0)
    said = F.when(F.col(column).isin(codes), F.col(column)).otherwise("") if codes else F.lit("")
    for r in docs.where(F.col(column).isNotNull()).groupBy("vote", said.alias("said")).count().collect():
        if r["vote"] is not None:
            seen[r["vote"], at.get(r["said"], len(codes))] += r["count"]
    seen += 1.0 + CHANCE * seen.sum(axis=1, keepdims=True) / seen.shape[1]
    return seen / seen.sum(axis=1, keepdims=True)


def _fuser(codes: list[str], declared: np.ndarray, suffix: np.ndarray, overall: np.ndarray):
    names = [*codes, UNKNOWN]
    at = {c: i for i, c in enumerate(codes)}
    n = len(codes)

    def prior(row: dict) -> np.ndarray:
        own = np.zeros(n)
        if row["vote"] is not None and row["vote"] < n:
            own[row["vote"]] = 1.0
        level = np.maximum(overall - own, 0) + 1.0
        level = level / level.sum()
        for key in ("ending", "domain", "host"):
            found = row[f"{key}_votes"]
            if found is not None:
                votes = np.zeros(n)
                for v in found:
                    votes[v["vote"]] = v["n"]
                votes = np.maximum(votes - own, 0)
                level = (votes + LEAN * level) / (votes.sum() + LEAN)
        level = (1 - CHANCE) * level + CHANCE / n
        return np.append((1 - UNKNOWN_PRIOR) * level, UNKNOWN_PRIOR)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for row in batch.to_pylist():
                if not row["grams"] or not n and row["code"] is None:
                    out.append((row["doc_id"], UNKNOWN, 0.0, UNKNOWN, False))
                    continue
                if not n:
                    out.append((row["doc_id"], row["code"], 1.0, UNKNOWN, True))
                    continue
                ll = np.asarray(row["ll"])
                log = ll + np.log(prior(row))
                if row["code"] is not None:
                    log = log + np.log(declared[:, at.get(row["code"], n)])
                if row["suffix"] is not None:
                    log = log + np.log(suffix[:, at.get(row["suffix"], n)])
                p = np.exp(log - log.max())
                p /= p.sum()
                best, own = int(p.argmax()), at.get(row["code"], n)
                kept = best < n and p[best] >= MIN_PROBABILITY
                language, rare = names[best], row["code"] is not None and own == n
                if not kept and rare:
                    best, language, kept = n, row["code"], True
                elif not kept and ll[own] > ll[n]:
                    best = own if best == n else best
                    language, kept = names[best], True
                out.append((row["doc_id"], language, float(p[best]), names[int(ll.argmax())], bool(kept)))
            columns = list(zip(*out)) or [()] * 5
            kinds = (pa.int64(), pa.string(), pa.float64(), pa.string(), pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)],
                ["doc_id", "language", "probability", "text_language", "kept"],
            )

    return run


def identify(
    docs: DataFrame, doc_id: Column, text: Column, declared: Column, address: Column, host: Column
) -> DataFrame:
    """Per row: ``doc_id``, ``language``, ``probability``, ``text_language`` (of the text
    alone), ``kept``."""
    read = docs.select(
        doc_id.cast("long").alias("doc_id"), text.alias("text"), code_of(declared).alias("code"),
        address.alias("address"), F.lower(host).alias("host"),
    )
    codes, log = fit(read)
    n = len(codes)
    labels = F.split("host", r"\.")
    named = read.select(
        "doc_id", "text", "code", suffix_of(F.col("address"), codes).alias("suffix"), "host",
        F.when(F.size(labels) > 2, F.array_join(F.slice(labels, -2, 2), ".")).alias("domain"),
        F.when(F.size(labels) > 1, F.element_at(labels, -1)).alias("ending"),
    )
    schema = "doc_id bigint, code string, suffix string, host string, domain string, ending string, grams bigint, ll array<double>"
    scored = named.mapInArrow(tidy(_likelihoods(log)), schema)
    # Ties go to the first; documents without letters have no vote.
    vote = F.when(F.col("grams") > 0, F.array_position("ll", F.array_max("ll")).cast("int") - 1)
    scored = land(scored.withColumn("vote", vote), "likelihoods")

    declared_is, suffix_is = _matrix(scored, "code", codes), _matrix(scored, "suffix", codes)
    overall = np.zeros(n)
    for r in scored.where(F.col("vote") < n).groupBy("vote").count().collect():
        overall[r["vote"]] = r["count"]
    fused = scored
    if n:
        for key in ("ending", "domain", "host"):
            # Landed, so that its size is known: broadcast if small, else a join that
            # splits hot hosts.
            fused = fused.join(land(_vote_table(scored, key, n), f"{key}-votes"), key, "left")
    else:
        fused = fused.withColumns({f"{k}_votes": F.lit(None).cast("array<struct<vote:int,n:bigint>>") for k in ("ending", "domain", "host")})
    out = "doc_id bigint, language string, probability double, text_language string, kept boolean"
    return fused.select(
        "doc_id", "code", "suffix", "grams", "ll", "vote", "ending_votes", "domain_votes", "host_votes"
    ).mapInArrow(tidy(_fuser(codes, declared_is, suffix_is, overall)), out)


def identify_documents(docs: DataFrame) -> DataFrame:
    """The documents table: ``lang`` is the declared language, ``source`` address and host."""
    return identify(docs, F.col("doc_id"), F.col("text"), F.col("lang"), F.col("source"), F.col("source"))


def identify_pages(pages: DataFrame, text: Column) -> DataFrame:
    """Web pages (``page_id``, ``url``, ``html``): the markup's ``lang``, the address, its host."""
    declared = F.regexp_extract("html", r"(?is)<html\b[^>]*?\blang\s*=\s*[\"']?([A-Za-z_-]+)", 1)
    host = F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#:]+)", 1)
    return identify(
        pages, F.col("page_id"), text, F.when(declared != "", declared), F.col("url"), F.when(host != "", host)
    )
