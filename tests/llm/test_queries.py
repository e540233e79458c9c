"""The registered queries: against their SQL, or against brute force on whole small tables."""

import re
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from rollbook.llm.queries import ORACLE, QUERIES

TABLES = ("documents", "pages", "benchmark", "labels", "conversations")


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


@pytest.fixture(scope="module")
def given(duck):
    return {i: t or "" for i, t in duck.execute("SELECT doc_id, text FROM documents").fetchall()}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, duck, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    result = duck.execute(ORACLE[name])
    names = [c[0] for c in result.description]
    assert sorted(names) == columns
    want = sorted(repr([row[names.index(c)] for c in columns]) for row in result.fetchall())
    got = sorted(repr([row[c] for c in columns]) for row in df.collect())
    assert got == want
    assert got


def test_operators():
    assert {int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES} == set(range(1, 14))


def test_quality_on_held_out_rows(spark, duck):
    sf_dir = "/root/testdata/sf0.01"
    rows = QUERIES["op1_quality"](spark, sf_dir).collect()
    labels = dict(duck.execute(f"SELECT doc_id, quality FROM '{sf_dir}/labels.parquet'").fetchall())
    assert len(rows) == 1000
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in rows)
    held = [(r["score"], labels[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    good = [s for s, y in held if y == 1]
    bad = [s for s, y in held if y == 0]
    ranked = np.mean([g > b for g in good for b in bad])
    assert ranked > 0.95
    assert np.mean([(s >= 0.7) == y for s, y in held]) > 0.9


def test_language_agrees_with_the_corpus(spark, duck, sf_dir):
    rows = QUERIES["op3_language"](spark, sf_dir).collect()
    lang = dict(duck.execute("SELECT doc_id, lang FROM documents").fetchall())
    assert {r["doc_id"] for r in rows} == set(lang)
    assert np.mean([r["text_language"] == lang[r["doc_id"]] for r in rows]) > 0.97
    assert np.mean([r["language"] == lang[r["doc_id"]] for r in rows]) > 0.99
    assert np.mean([r["kept"] for r in rows]) > 0.98


def test_page_language_uses_what_pages_declare(spark, duck, sf_dir):
    rows = {r["page_id"]: r for r in QUERIES["op3_page_language"](spark, sf_dir).collect()}
    pages = duck.execute("SELECT page_id, regexp_extract(html, '<html lang=\"([a-z]+)\"', 1), url FROM pages").fetchall()
    assert set(rows) == {p[0] for p in pages} and all(r["kept"] for r in rows.values())
    assert np.mean([rows[i]["language"] == lang for i, lang, _ in pages if lang]) > 0.9


def test_license_sql_on_bodies_headers_and_spdx_lines(spark, frame, tmp_path):
    from rollbook.llm.license import template_rows

    texts = [text for _, text in template_rows()]
    rows = [(i, f"Some file. {text} More of it follows here.") for i, text in enumerate(texts)]
    rows += [(1000 + i, text.replace(" the ", " any ", 1)) for i, text in enumerate(texts)] + [(2000, texts[-1]), (2001, None), (2002, "")]
    frame(rows, "doc_id long, text string").select("doc_id", "text").write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    want = con.execute(f"SELECT doc_id, template_id, matched, shingles FROM ({ORACLE['op4_license_scan']})").fetchall()
    got = [tuple(r) for r in QUERIES["op4_license_scan"](spark, str(tmp_path)).select("doc_id", "template_id", "matched", "shingles").collect()]
    assert sorted(got) == sorted(want)
    assert {i for i, *_ in got if i < 1000} == set(range(len(texts))) and len({t for _, t, *_ in got}) == len(texts)


def test_packing_holds_each_token_once(spark, sf_dir, given):
    bpe = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = QUERIES["op5_pack"](spark, sf_dir).collect()
    ids = {i: [*bpe.encode(t, add_special_tokens=False).ids, 0] for i, t in given.items()}
    at, filled = dict.fromkeys(ids, 0), {}
    for r in sorted(rows, key=lambda r: (r["doc_id"], r["start"])):
        assert r["start"] == at[r["doc_id"]] and r["length"] > 0
        at[r["doc_id"]] += r["length"]
        piece = np.array(ids[r["doc_id"]][r["start"] : at[r["doc_id"]]], dtype="<u4")
        assert r["ids_crc32"] == zlib.crc32(piece.tobytes()) and r["doc_tokens"] == len(ids[r["doc_id"]])
    assert at == {i: len(x) for i, x in ids.items()}
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == filled.get(r["sequence_id"], 0)
        filled[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(filled.values()) <= 1024
    padding = sum(1024 - n for n in filled.values()) - max(1024 - n for n in filled.values())
    assert padding < 0.02 * sum(filled.values())


def test_token_counts_equal_the_library(spark, sf_dir, given):
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    rows = QUERIES["op8_token_counts"](spark, sf_dir).collect()
    want = {i: (len(t.encode()), len(library.encode(t))) for i, t in given.items()}
    assert {r["doc_id"]: (r["n_bytes"], r["n_tokens"]) for r in rows} == want
    assert all(r["over_limit"] == (r["n_tokens"] > 4096) for r in rows)


def test_leaks_equal_an_exhaustive_comparison(spark, duck, sf_dir, given):
    items = {i: re.findall(r"[^\W_]+", t.lower()) for i, t in duck.execute("SELECT item_id, text FROM benchmark").fetchall()}
    want = set()
    for i, text in given.items():
        doc = re.findall(r"[^\W_]+", text.lower())
        code = {w: k for k, w in enumerate({*doc, *(w for x in items.values() for w in x)})}
        d = np.array([code[w] for w in doc])
        for j, words in items.items():
            q, n = np.array([code[w] for w in words]), min(20, len(words))
            if n < 5:
                continue
            for offset in range(n - len(q), len(d) - n + 1):
                a, b = max(0, -offset), min(len(q), len(d) - offset)
                same = np.concatenate(([0], np.cumsum(q[a:b] == d[a + offset : b + offset])))
                if b - a >= n and (same[n:] - same[:-n]).max() >= np.ceil(0.8 * n - 1e-9):
                    want.add((i, j))
                    break
    rows = QUERIES["op10_decontaminate"](spark, sf_dir).collect()
    assert {(r["doc_id"], r["item_id"]) for r in rows} == want
    assert len(rows) == len(want) > 0
