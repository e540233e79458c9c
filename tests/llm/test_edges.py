"""Nulls, empty and very long texts, ties, repeated rows, empty tables, clashing names."""

import itertools
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from rollbook.llm import chat, decontaminate, exact, language, license, near, packing, quality, template, tokens
from rollbook.llm.shared import WHITE, shingle_hashes, without, word_hashes
from rollbook.llm.tokenizers_of import ByteBpe, PieceBpe
from rollbook.session import fresh_dir

BPE, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
LONG = "many words of one very long text, again and again. " * 40_000

ODD = [
    "", " ", "  ", "a  b", " a", "a ", "a \n b", "\n\n x", "a <|endoftext|> b", "it's 12 ab12", "▁a ▁", "<s> x </s>",
    "tab\t x", "a　 b", "é" * 70 + " z", "\x1c x \x1f", "a\r\n b", "x.\nY", "ÀÇ×÷ß.", "one.\n\ntwo", "ŉŋ ſ", "'s 's", "a\x00b",
    "日本語 です。", "don't. Won't!\nOk", "x\u0301 y", "😀 😀",
]


def rows_of(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


@pytest.mark.parametrize("text", ODD)
def test_memoised_tokenizers_equal_their_libraries(text):
    bpe, pieces = _TOKENIZERS()
    assert np.frombuffer(bpe.encode(text), "<u4").tolist() == bpe.library.encode(text, add_special_tokens=False).ids
    assert pieces.count(text) == len(pieces.library.encode(text))


def _TOKENIZERS(held=[]):  # noqa: B006
    if not held:
        held.append((ByteBpe(BPE), PieceBpe(PIECES)))
    return held[0]


def test_texts_together_equal_the_library():
    bpe, _ = _TOKENIZERS()
    rng = random.Random(5)
    bits = [
        *("foo", "Bar", "é", "mañana", "漢", "×", "1", "½", "'s", "'", "n't", "<|endoftext|>", "|", '"', "ʰ", "\u0301"),
        *(",", ".", "!", ";", ":", "?", ",,", " ", " ", " ", "  ", "\n", "\n\n", "\t", "\r\n", "\xa0", "\x1c", "\0", "\1"),
    ]
    for _ in range(300):
        texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 9))) for _ in range(rng.randint(0, 9))]
        want = [bpe.library.encode(text, add_special_tokens=False).ids for text in texts]
        assert [np.frombuffer(ids, "<u4").tolist() for ids in bpe.encode_all(texts)] == want, texts


def test_a_word_is_looked_up_once_whatever_follows_it():
    bpe, asked = ByteBpe(BPE), []
    bpe.rest.make = lambda word: asked.append(word) or bpe._after_space(word)
    bpe.encode_all(["a zorblat, zorblat. zorblat; zorblat", "b zorblat! zorblat? zorblat: zorblat.\nc zorblat"])
    assert asked.count("zorblat") == 1 and not [word for word in asked if "zorblat" in word and word != "zorblat"]


def test_word_hashes_follow_words():
    a, b = (word_hashes(t, WHITE) for t in (b"x  the same\twords", b"the same words x"))
    assert a.tolist() == [b[3], *b[:3]]
    assert len(set(b.tolist())) == 4 and not len(word_hashes(b" \n", WHITE))
    assert len(shingle_hashes(b, 9)) == 1 and len(shingle_hashes(b, 2)) == 3


# --- quality -------------------------------------------------------------------------


def test_word_vectors_and_pooling_equal_brute_force(documents):
    texts = ["the cat saw the dog", "The DOG saw 12 cats!\n\nthe the end", None, "", "dog", "a b a b c d e f g " * 50]
    vectors = quality.word_vectors(documents(list(enumerate(texts))).select("text"))
    index, sums = quality.index_vectors(), {}
    assert (np.abs(index).sum(axis=1) == 4).all() and ((index == 0) | (np.abs(index) == 1)).all()
    for text in texts:
        words = quality.places(text or "").tolist()
        for i, word in enumerate(words):
            for j in range(max(0, i - quality.REACH), min(len(words), i + quality.REACH + 1)):
                if i != j:
                    sums[word] = sums.get(word, np.zeros(quality.WIDTH)) + index[words[j]]
    for word in range(quality.PLACES):
        want = sums.get(word, np.zeros(quality.WIDTH))
        assert np.allclose(vectors[word], want / max(np.linalg.norm(want), 1e-9))
    words = quality.places(texts[1])
    held = np.array([vectors[w] for w in words])
    assert np.allclose(quality.pooled(texts[1], vectors), [*held.mean(0), *np.sqrt(((held - held.mean(0)) ** 2).mean(0))])
    assert not quality.pooled("", vectors).any()
    # Different words have different places.
    common = "the of and to in is was for that with".split()
    assert len({quality.places(w)[0] for w in common}) == len(common)


def test_quality_edges(documents, frame, spark):
    docs = documents([(1, "good words stand here"), (2, "BAD!! BAD!! $$$"), (3, None), (4, ""), (None, "x"), (1, "good words stand here"), (5, LONG)])
    labels = frame([(1, 1), (1, 1), (2, 0), (None, 1), (4, None), (9, 1), (3, 7)], "doc_id long, quality int")
    model = quality.fit(docs, labels)
    got = rows_of(quality.score(docs, model), "doc_id", "score")
    assert len(got) == 7 and all(0 <= s <= 1 for _, s in got)
    score = dict(got)
    assert score[3] == score[4] and len([g for g in got if g[0] == 1]) == 2

    only = quality.fit(docs, labels.where("quality = 1"))
    assert {s for _, s in rows_of(quality.score(docs, only), "doc_id", "score")} == {1.0}
    empty = docs.limit(0)
    assert quality.score(empty, quality.fit(empty, labels.limit(0))).count() == 0


def test_quality_places_know_repetition_and_case():
    assert (quality.places("the the the") == [quality.places("the")[0], quality.AGAIN[0], quality.AGAIN[0]]).all()
    shapes = [quality.places(t)[0] for t in ("word", "Word", "WORD", "***", "123", "\n")]
    assert sorted(shapes) == [shapes[i] for i in (0, 1, 2, 3, 4, 5)]


# --- main text -----------------------------------------------------------------------

PAGE = (
    "<!DOCTYPE html><html><head><title>T</title><script>var a='<p>no</p>';</script></head><body><header>Site</header>"
    "<nav><ul><li>Menu</ul></nav><main><h1>A &amp; B</h1><p>One<br>two <b>three<p>Four &#169; &lt;5&gt;"
    "<div class='ad box'>Buy</div><form><input>Send</form><div id=comments><p>First!</p></div></main>"
    "<div class=\"cookie-notice\">We use</div><footer>&copy; x</footer></body></html>"
)


def test_main_text_edges(frame, spark):
    pages = frame(
        [(1, "http://a.b/1", PAGE), (2, None, None), (3, "http://a.b/2", ""), (4, "nonsense", "plain <unclosed"), (None, "http://a.b/1", PAGE),
         (5, "http://a.b/3", "<p>" * 3000 + "deep" + "<div>" * 3000 + " text")],
        "page_id long, url string, html string",
    )
    got = {r["page_id"]: r for r in template.main_text(pages).collect()}
    assert got[1]["text"] == "A & B\nOne two three\nFour © <5>" and got[None]["text"] == got[1]["text"]
    assert got[2]["text"] == got[3]["text"] == "" and got[4]["text"] == "plain"
    assert got[5]["text"] == "deep\ntext" and all(r["n_chars"] == len(r["text"]) for r in got.values())
    assert template.main_text(pages.limit(0)).count() == 0


def test_labels_do_not_take_the_content_along(frame):
    body = "<p>" + "The story is told at some length here. " * 5
    pages = [
        f"<body><div id=content-sidebar-wrap><main>{body}</main><div class=sideBar>Links</div></div>",
        f"<body><div class='page header'><article class=post><div class=article-header><h1>Head</h1></div>{body}"
        "<p class=ad-slot2>Buy</p><article class=comment><p>First</article></article></div><div id=adBox1>Buy</div>",
    ]
    df = frame([(i, None, p) for i, p in enumerate(pages)], "page_id long, url string, html string")
    got = dict(rows_of(template.main_text(df), "page_id", "text"))
    story = ("The story is told at some length here. " * 5).strip()
    assert got == {0: story, 1: "Head\n" + story}


def test_template_goes_by_host(frame):
    def page(i, box):
        return f"<body><div><p>{box}</p><ul><li>same</ul></div><div><p>Article number {i} says something of its own</p></div></body>"

    rows = [(i, f"http://one.example/{i}", page(i, "Box of the site")) for i in range(8)]
    rows += [(100 + i, f"http://two.example/{i}", page(i, f"Box {i}")) for i in range(8)]
    got = dict(rows_of(template.main_text(frame(rows, "page_id long, url string, html string")), "page_id", "text"))
    assert got[3] == "Article number 3 says something of its own"
    assert got[103] == "Box 3\nArticle number 3 says something of its own"


def test_content_in_forms_main_and_named_sections(frame):
    story = "The story is told at some length here, in words of its own. " * 3
    p = f"<p>{story}</p>"
    pages = [
        f"<body><form id=aspnetForm><input value=x><nav>Menu</nav><div><article><h1>Head</h1>{p}</article></div></form>",
        f"<body><form id=aspnetForm><button>Go</button><div>{p}{p}</div></form><form class=search><label>Find</label><p>Enter words</p></form>",
        f"<body><header>Site</header><main><h1>Head</h1><p>Lead before it</p><article>{p}</article></main><footer>End</footer>",
        f"<body><article><h1>Head</h1>{p}<section class='related work'><h2>Work</h2>{p}</section>"
        "<div class='related links'><h3>More</h3><ul><li>Other story</ul></div><div class=social-share>Share this</div></article>",
        f"<body><div class=notice><p>{story}</p></div><article>{p}{p}</article><aside>{p}</aside>",
    ]
    df = frame([(i, None, x) for i, x in enumerate(pages)], "page_id long, url string, html string")
    got = dict(rows_of(template.main_text(df), "page_id", "text"))
    story = story.strip()
    assert got == {
        0: f"Head\n{story}", 1: f"{story}\n{story}", 2: f"Head\nLead before it\n{story}",
        3: f"Head\n{story}\nWork\n{story}", 4: f"{story}\n{story}",
    }


def test_template_counts_equal_brute_force(frame):
    """Hosts whose boxes carry no name: only the pages on which a subtree recurs decide."""
    rng = random.Random(6)
    rows, boxes = [], {}
    for host, n in (("big.example", 620), ("small.example", 20), ("tiny.example", 4)):
        for i in range(n):
            mine = [b for b, every in (("all", 1), ("tenth", 10), ("rare", 40), ("third", 3)) if i % every == 0]
            boxes[host, i] = mine
            inner = "".join(f"<div><ul><li>box {b} of {host}</ul></div>" for b in mine)
            story = " ".join(f"w{rng.randrange(10**6)}" for _ in range(30))
            rows.append((f"{host}/{i}", f"http://{host}/{i}", f"<body>{inner}<div><p>{story}</p></div></body>", story))
    rows = [(k, url, html, story) for k, (_, url, html, story) in enumerate(rows)]
    df = frame([r[:3] for r in rows] + [rows[0][:3]], "page_id long, url string, html string")  # one page twice
    got = dict(rows_of(template.main_text(df), "page_id", "text"))
    on = Counter((host, b) for (host, _), mine in boxes.items() for b in mine)
    pages = Counter(host for host, _ in boxes)
    is_template = lambda host, b: on[host, b] >= template.MANY_PAGES or (
        on[host, b] >= template.MIN_PAGES and on[host, b] >= template.MIN_SHARE * pages[host])
    for (k, _, _, story), ((host, _), mine) in zip(rows, boxes.items()):
        left = [f"box {b} of {host}" for b in mine if not is_template(host, b)]
        assert got[k] == "\n".join([*left, story])
    decided = {key: is_template(*key) for key in on}
    assert decided["big.example", "tenth"] and not decided["big.example", "rare"] and not decided["small.example", "tenth"]


# --- language ------------------------------------------------------------------------


def test_language_edges(documents, frame):
    en, de = "the house of the king and the queen by the sea", "das haus der könige und die see mit dem schiff"
    docs = documents(
        [(i, en if i % 2 else de, "en" if i % 2 else "de", f"s{i % 3}") for i in range(20)]
        + [(50, de, "en", "s1"), (51, None, "en", "s1"), (52, "12 345 !!", "en", None), (None, en, None, None), (53, "漢字仮名交じり文" * 9, None, "s1"), (54, LONG, "EN-us", "s2"), (1, en, "en", "s1")]
    )
    got = {}
    for r in language.identify_documents(docs).collect():
        got.setdefault(r["doc_id"], []).append(r)
    assert got[1][0]["language"] == "en" and got[1] == [got[1][0]] * 2 and got[2][0]["language"] == "de"
    assert got[50][0]["text_language"] == "de" and got[None][0]["kept"]
    assert not any(got[i][0]["kept"] for i in (51, 52, 53)) and got[51][0]["language"] == "und"
    assert language.identify_documents(docs.limit(0)).count() == 0
    assert not language.identify_documents(documents([(1, en)])).first()["kept"]


def test_rare_languages_are_not_lost_on_a_large_table(documents):
    en = "the house of the king and the queen by the sea"
    ka = "ქართული ენა არის საქართველოს სახელმწიფო ენა {} და მისი დამწერლობა ძველია"
    hy = "հայերենը հնդեվրոպական լեզու է և ունի իր այբուբենը"
    rows = [(i, f"{en} number{i}", "en", f"s{i % 3}") for i in range(4000)]
    # Five of 4,000 are a class; a code of one document cannot be held against it.
    rows += [(5000 + i, ka.format("აბგდე"[i] * 4), "ka", "s1") for i in range(5)]
    rows += [(6000, hy, "hy", "s1"), (6001, "漢字仮名交じり文" * 9, "en", "s1"), (6002, en, "xx", "s2"), (6003, "12 !!", "yy", "s2")]
    got = {r["doc_id"]: r for r in language.identify_documents(documents(rows)).collect()}
    assert all(got[5000 + i]["language"] == got[5000 + i]["text_language"] == "ka" and got[5000 + i]["kept"] for i in range(5))
    assert got[6000]["language"] == "hy" and got[6000]["kept"]
    assert got[6001]["language"] == "und" and not got[6001]["kept"]
    assert got[6002]["language"] == "en" and got[6002]["kept"] and not got[6003]["kept"]


def test_language_of_pages_uses_markup_address_and_host(frame):
    from pyspark.sql import functions as F

    en, de = "the house of the king and the queen by the sea", "das haus der könige und die see mit dem schiff"
    rows = [(i, f"http://x.example/{c}/{i}", f'<html lang="{c}">{t}') for i, (c, t) in enumerate([("en", en), ("de", de)] * 10)]
    rows += [(90, "http://x.example/de/90", "<html>so"), (91, "http://x.example/en/91", "<html>so")]
    pages = frame(rows, "page_id long, url string, html string")
    got = dict(rows_of(language.identify_pages(pages, F.regexp_replace("html", "<[^>]*>", " ")), "doc_id", "language"))
    assert got[0] == "en" and got[1] == "de" and (got[90], got[91]) == ("de", "en")


# --- licenses ------------------------------------------------------------------------


def test_license_edges(documents, frame, spark):
    gpl = "This work is licensed under the GNU General Public License, version 3."
    docs = documents(
        [(1, f"before. {gpl} after"), (2, gpl.upper()), (3, None), (4, ""), (5, "four words are short"), (None, gpl), (2, gpl), (6, LONG + gpl),
         (7, gpl.replace("General", "Special")), (8, "x " + gpl[5:] + " y")]
    )
    found = license.scan(docs, license.default_templates(spark)).where("template_id = 'GPL-3.0/0'")
    assert rows_of(found, "doc_id", "matched") == sorted([(1, 8), (2, 8), (2, 8), (None, 8), (6, 8), (8, 7)], key=repr)
    assert license.scan(docs.limit(0), license.default_templates(spark)).count() == 0
    none = frame([("a", None), ("b", "?!")], "template_id string, text string")
    assert license.scan(docs, none).count() == 0


def test_default_templates_hold_bodies_and_spdx_lines(documents, spark):
    body = {r["template_id"]: r["text"] for r in license.default_templates(spark).collect()}
    edited = body["MIT/body"].replace("AUTHORS OR COPYRIGHT HOLDERS", "FOUNDATION").replace("sublicense", "lease")
    docs = documents(
        [(1, f"Copyright x. {body['MIT/body']} code"), (2, edited), (3, "a " + body["GPL-3.0/text"] + " b"), (4, "// SPDX-License-Identifier: GPL-2.0-only x"),
         (5, "so " + body["ISC/body"].lower()), (6, "no license, spdx license"), (8, "# SPDX-License-Identifier: MIT x"), (9, "spdx-license-identifier: isc"), (7, body["Apache-2.0/text"].replace("derivative", "derived"))]
    )
    found = {}
    for r in license.scan(docs, license.default_templates(spark)).collect():
        found.setdefault(r["doc_id"], set()).add(r["template_id"])
    assert "MIT/body" in found[1] and "MIT/body" in found[2] and "GPL-3.0/text" in found[3] and found[4] == {"GPL-2.0-only/spdx"}
    assert "ISC/body" in found[5] and 6 not in found and found[8] == {"MIT/spdx"} and found[9] == {"ISC/spdx"} and "Apache-2.0/text" in found[7]


def test_license_retrieval_misses_nothing_that_would_match(documents, frame):
    """Random edits of templates of all lengths: what exact containment accepts is found."""
    draw = np.random.default_rng(3)
    vocabulary = [f"w{i}" for i in range(400)]
    templates, docs, want = [], [], set()
    for k in range(60):
        words = draw.choice(vocabulary, 5 + k).tolist()
        templates.append((str(k), " ".join(words)))
        for e in range(3):
            edited = list(words)
            for _ in range(e):
                edited.insert(int(draw.integers(0, len(edited) + 1)), "extra")
            doc = [*draw.choice(vocabulary, int(draw.integers(0, 9))).tolist(), *edited, *draw.choice(vocabulary, 7).tolist()]
            docs.append((len(docs), " ".join(doc)))
    runs = lambda w: {tuple(w[i : i + 5]) for i in range(len(w) - 4)}
    held = [(i, runs(t.split())) for i, t in docs]
    for t, text in templates:
        own = runs(text.split())
        want |= {(i, t) for i, have in held if len(own & have) >= 0.8 * len(own)}
    got = license.scan(documents(docs), frame(templates, "template_id string, text string"))
    assert rows_of(got, "doc_id", "template_id") == sorted(want, key=repr) and len(want) > 60


# --- packing -------------------------------------------------------------------------


def test_packing_edges(documents):
    docs = documents([(1, "a b c"), (2, None), (3, ""), (None, "x"), (1, "a b c"), (4, LONG)])
    rows = packing.pack(docs.coalesce(1), BPE).collect()
    tokens_of = {}
    for r in rows:
        tokens_of[r["doc_id"]] = tokens_of.get(r["doc_id"], 0) + r["length"]
    assert tokens_of[2] == tokens_of[3] == 1 and tokens_of[1] == 2 * rows_of(packing.pack(docs.where("doc_id = 1"), BPE), "doc_tokens")[0][0]
    assert max(r["offset"] + r["length"] for r in rows) <= 1024
    assert packing.pack(docs.limit(0), BPE).count() == 0


def test_cuts_cost_the_least():
    """Against the plain recursion, on random places and penalties."""
    draw = np.random.default_rng(1)
    for _ in range(200):
        window = int(draw.integers(3, 12))
        places = np.cumsum(draw.integers(1, min(4, window) + 1, int(draw.integers(1, 14)))).tolist()
        penalties = draw.integers(0, 9, len(places)).tolist()
        penalties[-1] = 0
        price = dict(zip(places, penalties))
        best = {0: 0}
        for j in places:
            best[j] = min(best[i] + window - (j - i) + price[j] for i in best if j - window <= i < j)
        cuts = packing.choose_cuts(places, penalties, window)
        cost = sum(window - (b - a) + price[b] for a, b in itertools.pairwise([0, *cuts]))
        assert cuts[-1] == places[-1] and cost == best[places[-1]]
        assert all(b - a <= window for a, b in itertools.pairwise([0, *cuts]))


# --- exact duplicates ----------------------------------------------------------------


def test_exact_edges(documents):
    docs = documents(
        [(5, "a b"), (3, "ab"), (4, "a\tb"), (9, "a b"), (7, None), (6, ""), (8, "\n "), (None, "a b c"), (2, "ABC"), (2, "ABC"), (10, LONG), (11, LONG)]
    )
    got = rows_of(exact.duplicates(docs), "doc_id", "keep_id", "group_size", "kept")
    assert got == sorted(
        [(5, 4, 4, False), (3, 4, 4, False), (4, 4, 4, True), (9, 4, 4, False), (7, 8, 3, False), (6, 8, 3, False), (8, 8, 3, True),
         (None, None, 1, True), (2, 2, 2, True), (2, 2, 2, True), (10, 10, 2, True), (11, 10, 2, False)],
        key=repr,
    )
    assert exact.duplicates(docs.limit(0)).count() == 0


# --- near duplicates -----------------------------------------------------------------


def test_near_edges(documents):
    base = [f"word{i}" for i in range(60)]
    text = " ".join(base)
    docs = documents(
        [(5, text), (3, text.upper()), (9, text + " tail"), (7, None), (6, ""), (8, " \n"), (None, text), (None, "lonely row here"), (2, "one"), (1, "one"),
         (4, "one two"), (20, LONG), (21, LONG + "end"), (3, text.upper())]
    )
    got = rows_of(near.near_groups(docs, 2), "doc_id", "n_shingles", "component_id", "kept")
    assert got == sorted(
        [(5, 59, 3, False), (3, 59, 3, True), (3, 59, 3, True), (9, 60, 3, False), (7, 0, 7, True), (6, 0, 6, True), (8, 0, 8, True),
         (None, 59, 3, False), (None, 2, None, True), (2, 1, 1, False), (1, 1, 1, True), (4, 1, 4, True), (20, 10, 20, True), (21, 11, 20, False)],
        key=repr,
    )
    assert near.near_groups(docs.limit(0), 2).count() == 0


def test_near_chains_and_large_groups_equal_brute_force(documents):
    """A large group around one text, a chain whose ends differ, a shared passage, and pairs
    close to the threshold on both sides."""
    draw = np.random.default_rng(5)
    new = lambda n, at=itertools.count(): [f"w{next(at)}" for _ in range(n)]
    texts, base = [], new(120)
    for _ in range(70):
        words = list(base)
        for i in draw.choice(120, int(draw.integers(0, 22)), replace=False):
            words[i] = new(1)[0]
        texts.append(words)
    link = new(100)
    for _ in range(12):
        link = link[6:] + new(6)
        texts.append(link)
    passage = new(50)
    texts += [new(45) + passage + new(10) for _ in range(40)]
    for edits in range(3, 10):
        one = new(100)
        texts += [one, [*one[:-edits], *new(edits)], [*one, *new(2 * edits)]]
    order = draw.permutation(len(texts))
    given = {int(i): texts[k] for i, k in enumerate(order)}
    sets = {i: {tuple(w[j : j + 2]) for j in range(len(w) - 1)} for i, w in given.items()}
    root = {i: i for i in sets}
    for a, b in itertools.combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both) and root[a] != root[b]:
            lo, hi = sorted((root[a], root[b]))
            root = {i: lo if r == hi else r for i, r in root.items()}
    got = near.near_groups(documents([(i, " ".join(w)) for i, w in given.items()]), 2)
    assert dict(rows_of(got, "doc_id", "component_id")) == root


@pytest.mark.parametrize("seed", [1, 2])
def test_near_groups_just_below_the_threshold(documents, seed):
    """Most members of a group are too far from its middle and from each other; families within
    it share edits, by which they link; some members link with the middle by their sizes."""
    draw = np.random.default_rng(seed)
    new = lambda n, at=itertools.count(): [f"w{next(at)}" for _ in range(n)]
    base, texts = new(120), []

    def edited(words, n):
        words = list(words)
        for i in draw.choice(len(words), n, replace=False):
            words[i] = new(1)[0]
        return words

    texts += [edited(base, int(draw.integers(9, 17))) for _ in range(70)]
    for _ in range(5):
        family = edited(base, 9)
        texts += [edited(family, int(draw.integers(2, 7))) for _ in range(8)]
    texts += [edited(base, int(draw.integers(0, 4))) for _ in range(int(draw.integers(0, 3)))]
    given = {int(i): texts[k] for i, k in enumerate(draw.permutation(len(texts)))}
    sets = {i: {tuple(w[j : j + 2]) for j in range(len(w) - 1)} for i, w in given.items()}
    root = {i: i for i in sets}
    for a, b in itertools.combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both) and root[a] != root[b]:
            lo, hi = sorted((root[a], root[b]))
            root = {i: lo if r == hi else r for i, r in root.items()}
    assert 3 < len(set(root.values())) < len(root)
    got = near.near_groups(documents([(i, " ".join(w)) for i, w in given.items()]), 2)
    assert dict(rows_of(got, "doc_id", "component_id")) == root


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 130)] + [(7, 7), (3, 2)]
    got = dict(rows_of(near.components(spark.createDataFrame(edges, "a long, b long")), "u", "root"))
    assert got == {**dict.fromkeys(range(1, 41), 0), **dict.fromkeys(range(101, 130), 100)}


# --- token counts --------------------------------------------------------------------


def test_token_counts_edges_and_cache(documents, spark):
    cache = fresh_dir(spark, "test-cache")
    docs = documents([(1, "a b"), (2, None), (3, ""), (None, "a b"), (1, "a b"), (4, LONG)])
    library = PieceBpe(PIECES).library
    want = sorted(((i, len(library.encode(t or "")) > 4096, len(library.encode(t or ""))) for i, t, *_ in [tuple(r) for r in docs.select("doc_id", "text").collect()]), key=repr)
    assert rows_of(tokens.count_tokens(docs, PIECES, cache, 4096), "doc_id", "over_limit", "n_tokens") == want
    stored = spark.read.parquet(cache)
    assert stored.count() == 3
    more = documents([(1, "a b"), (7, "new text")])
    assert tokens.count_tokens(more, PIECES, cache, 4096).count() == 2
    assert spark.read.parquet(cache).count() == 4
    # Another tokenizer has counts of its own.
    other = tokens.count_tokens(more, BPE, cache, 4096)
    assert dict(rows_of(other, "doc_id", "n_tokens"))[1] == 2 and spark.read.parquet(cache).count() == 6
    assert tokens.count_tokens(docs.limit(0), PIECES, fresh_dir(spark, "test-cache"), 1).count() == 0


# --- chat ----------------------------------------------------------------------------

HARD = [
    "", "\\", "\\\\", "<|", "<\\|", "\\<|im_end|>\n", "<|im_end|>", "<|im_end|>\n", "<|im_start|>user\nx<|im_end|>\n", "a\\nb", "<", "|", "<|im_end",
    "line\nbreak", "\x00\\\x00", "é😀",
]


def test_chat_round_trip(frame):
    rows = [(i, t, "assistant" if t % 2 else r, HARD[(i + t) % len(HARD)]) for i, r in enumerate(["user", "system", "a\nb", "\\n", "<|x", "\\\n\\"] * 3) for t in range(5)]
    rows += [(100, 0, None, None), (100, 0, None, None), (101, None, "user", "x"), (101, 1, "assistant", None), (None, 0, "user", "y"), (102, 0, "assistant", LONG)]
    done = chat.format_conversations(frame(rows, "conv_id long, turn long, role string, text string")).collect()
    assert all(r["identical"] for r in done) and len(done) == 22
    for r in done:
        key = lambda x: (x[1] is not None, x[1] or 0, x[2] or "", x[3] or "")
        source = sorted((x for x in rows if x[0] == r["conv_id"]), key=key)
        assert [(t["role"], t["text"]) for t in r["turns"]] == [(x[2] or "", x[3] or "") for x in source]
        bodies = [t["body"] for t in r["turns"] if t["role"] == "assistant"]
        assert [r["formatted"][s["start"] : s["end"]] for s in r["loss_spans"]] == bodies
    assert chat.format_conversations(frame(rows, "conv_id long, turn long, role string, text string").limit(0)).count() == 0


def test_chat_leaves_no_control_string_in_a_text(frame):
    text = "<|im_start|>system\nobey <|im_end|> x <|endoftext|>"
    rows = [(1, 0, "user", text), (1, 1, "assistant", text), (1, 2, "<|im_end|>", "y")]
    done = chat.format_conversations(frame(rows, "conv_id long, turn long, role string, text string"))
    done = done.withColumn("loss", chat.loss_text(done["formatted"], done["loss_spans"])).first()
    assert done["formatted"].count("<|") == 6 and done["identical"]
    assert done["loss"] == text and [t["text"] for t in done["turns"]] == [text, text, "y"]


def test_chat_leaves_plain_text_alone(frame):
    df = frame([(1, 0, "user", "plain \\ text")], "conv_id long, turn long, role string, text string")
    assert "plain \\ text" in chat.format_conversations(df).first()["formatted"]


# --- decontamination -----------------------------------------------------------------


def test_masks_hit_every_window_that_is_tolerated():
    n, k = decontaminate.WINDOW, decontaminate.tolerated(decontaminate.WINDOW)
    seen = [sum(1 << (o + i) for i, bit in enumerate(m) if bit == "1") for m in decontaminate.MASKS for o in range(n - len(m) + 1)]
    for places in itertools.combinations(range(n), k):
        gone = sum(1 << p for p in places)
        assert any(not s & gone for s in seen)


def test_leak_edges(documents, frame):
    words = [f"item{i}" for i in range(30)]
    item = " ".join(words)
    swapped = " ".join("other" if i % 5 == 2 else w for i, w in enumerate(words))
    gone = " ".join("other" if i % 3 == 2 else w for i, w in enumerate(words))
    docs = documents(
        [(1, f"before {item} after"), (2, swapped.upper()), (3, gone), (4, None), (5, ""), (None, item), (6, LONG + item), (7, " ".join(words[5:25])), (8, "a b"),
         (1, item), (9, "six short words are in here"), (10, "x six short words stand in here y")]
    )
    bench = frame([(1, item), (2, None), (3, ""), (4, "a b"), (5, "six short words are in here")], "item_id long, text string")
    found = rows_of(decontaminate.find_leaks(docs, bench), "doc_id", "item_id")
    want = [(1, 1), (1, 1), (2, 1), (6, 1), (7, 1), (None, 1), (8, 4), (9, 5), (10, 5)]
    assert found == sorted(want, key=repr)
    assert rows_of(decontaminate.find_leaks(docs, bench, block_words=8), "doc_id", "item_id") == found
    left = decontaminate.remove_leaks(docs, bench)
    assert left.columns == docs.columns and [r[0] for r in rows_of(left, "doc_id")] == [3, 4, 5]
    assert decontaminate.find_leaks(docs, bench.limit(0)).count() == 0
    assert decontaminate.remove_leaks(docs.limit(0), bench).count() == 0


def test_leaks_in_any_script_and_typography(documents, frame):
    item = "北京大学的研究人员昨天发表了一篇关于气候变化的新论文"
    plain = "it's the well-known case - a 'quoted' passage of 20 words, which someone copied; Été and all, from one page to another"
    marks = plain.replace("'", "’").replace("-", "—").replace("a ’", "a ‘").replace(" - ", "—").replace(", ", ",\u00a0").replace(" of ", "\u3000of\u202f")
    thai = "ภาษาไทยเป็นภาษาที่มีระดับเสียงของคำแน่นอน"
    docs = documents(
        [(1, "他们说" + item + "。然后大家都回家了"), (2, f"before “{marks.upper()}” after"), (3, "xx" + thai + "ครับ"), (4, "北京大学在中国，气候很好。"),
         (5, "先说" + item.replace("昨", "今").replace("新", "旧") + "再说")]
    )
    bench = frame([(1, item), (2, plain), (3, thai)], "item_id long, text string")
    assert rows_of(decontaminate.find_leaks(docs, bench), "doc_id", "item_id") == [(1, 1), (2, 2), (3, 3), (5, 1)]
    words = decontaminate.words_of("Ab\u00a0c—d’e 第3章\u3000été_x \ud800")
    assert words.tolist() == [decontaminate.words_of(w)[0] for w in ("ab", "c", "d", "e", "第", "3", "章", "été", "x")]


def test_without_takes_null_for_null(documents, spark):
    docs = documents([(1, "x"), (None, "y"), (2, "z")])
    left = without(docs, spark.createDataFrame([(None,), (2,)], "gone long"))
    assert [r["doc_id"] for r in left.collect()] == [1]
