"""Posteriors of language identification against a direct computation from their definition."""

import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from rollbook.llm import language as lang

WORDS = {
    "en": "the house of king and queen by sea with ship over old hill under bright moon".split(),
    "de": "das haus der könige und die see mit dem schiff über alten hügel unter hellem mond".split(),
    "fr": "la maison du roi et de reine près mer avec bateau sur vieille colline sous lune".split(),
}


def rows_of_a_web(seed):
    rng, rows = random.Random(seed), []
    hosts = ["www.one.example.com", "de.two.example.com", "news.three.example.fr", "single", ""]
    for i in range(90):
        code = rng.choice(list(WORDS))
        text = " ".join(rng.choice(WORDS[code if rng.random() < 0.9 else rng.choice(list(WORDS))]) for _ in range(rng.randint(0, 40)))
        declared = rng.choice([code, code, None, rng.choice(list(WORDS)), "xx" if i % 30 == 0 else code])
        host = hosts[(list(WORDS).index(code) + (rng.random() < 0.3)) % 5]
        path = rng.choice(["/" + code + "/page", "/other/page", ""])
        rows.append((i, text, declared, f"http://{host}{path}" if host else None, host or None))
    return rows


def direct(rows):
    """``id: (language, probability, language of the text alone)`` from the rules, row by row."""
    codes = sorted(c for c, n in Counter(r[2] for r in rows if r[2]).items() if n >= lang.MIN_DOCS)
    seen = {c: Counter() for c in codes}
    for _, text, declared, *_ in rows:
        if declared in seen:
            seen[declared].update(set(lang.grams(text).tolist()))
    total = {c: sum(seen[c].values()) + 0.01 * lang.PLACES for c in codes}

    def likelihoods(text):
        found = lang.grams(text).tolist()
        each = [sum(math.log((seen[c][g] + 0.01) / total[c]) for g in found) for c in codes]
        return [x / (1 + len(found) / lang.GRAMS) for x in [*each, -len(found) * math.log(lang.PLACES)]], len(found)

    def suffix(url):
        rest = (url or "").split("://")[-1]
        host, path = rest.split("/")[0], rest.split("/")[1:2]
        labels = host.split(".")
        options = [path[0] if path else None, *([labels[0], labels[-1]] if len(labels) > 1 else [])]
        return next((o for o in options if o in codes), None)

    facts = {}
    for i, text, declared, url, host in rows:
        ll, n = likelihoods(text)
        labels = host.split(".") if host else []
        keys = {"ending": labels[-1] if len(labels) > 1 else None, "domain": ".".join(labels[-2:]) if len(labels) > 2 else None, "host": host}
        facts[i] = (ll, n, ll.index(max(ll)) if n else None, declared, suffix(url), keys)

    k = len(codes)
    said = {name: [[0.0] * (k + 1) for _ in range(k + 1)] for name in ("declared", "suffix")}
    votes, overall = defaultdict(lambda: [0.0] * k), [0.0] * k
    for _, _, vote, declared, suf, keys in facts.values():
        if vote is None:
            continue
        for name, value in (("declared", declared), ("suffix", suf)):
            if value is not None:
                said[name][vote][codes.index(value) if value in codes else k] += 1
        if vote < k:
            overall[vote] += 1
            for level, key in keys.items():
                if key is not None:
                    votes[level, key][vote] += 1

    def given(name, vote, value):
        row = said[name][vote]
        smooth = [x + 1 + lang.CHANCE * sum(row) / (k + 1) for x in row]
        return smooth[codes.index(value) if value in codes else k] / sum(smooth)

    out = {}
    for i, (ll, n, vote, declared, suf, keys) in facts.items():
        if not n:
            out[i] = (lang.UNKNOWN, 0.0, lang.UNKNOWN)
            continue
        own = [float(vote == v) for v in range(k)]
        level = [max(x - o, 0) + 1 for x, o in zip(overall, own)]
        level = [x / sum(level) for x in level]
        for name in ("ending", "domain", "host"):
            if keys[name] is not None and any(votes[name, keys[name]]):
                here = [max(x - o, 0) for x, o in zip(votes[name, keys[name]], own)]
                level = [(h + lang.LEAN * p) / (sum(here) + lang.LEAN) for h, p in zip(here, level)]
        level = [(1 - lang.CHANCE) * p + lang.CHANCE / k for p in level]
        prior = [*((1 - lang.UNKNOWN_PRIOR) * p for p in level), lang.UNKNOWN_PRIOR]
        log = [x + math.log(p) for x, p in zip(ll, prior)]
        for name, value in (("declared", declared), ("suffix", suf)):
            if value is not None:
                log = [x + math.log(given(name, v, value)) for v, x in enumerate(log)]
        p = [math.exp(x - max(log)) for x in log]
        best = p.index(max(p))
        out[i] = ([*codes, lang.UNKNOWN][best], p[best] / sum(p), [*codes, lang.UNKNOWN][ll.index(max(ll))])
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_posteriors_equal_a_direct_computation(spark, seed):
    rows = rows_of_a_web(seed)
    df = spark.createDataFrame(rows, "id long, text string, declared string, url string, host string")
    got = lang.identify(df, F.col("id"), F.col("text"), F.col("declared"), F.col("url"), F.col("host")).collect()
    want = direct(rows)
    sure = 0
    for r in got:
        language, p, text_language = want[r["doc_id"]]
        assert r["text_language"] == text_language
        # Where a declared code overrules, the class and its probability are another's.
        if p >= lang.MIN_PROBABILITY and language != lang.UNKNOWN:
            assert r["language"] == language and r["probability"] == pytest.approx(p, abs=2e-4) and r["kept"]
            sure += 1
    assert len(got) == len(rows) and sure > 70
