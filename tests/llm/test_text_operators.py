"""Quality, scoring, fingerprints, chat, extraction: brute force, round trips, held-out accuracy, edge cases."""

import collections
import hashlib
import html
import math
import re
import zlib

import numpy as np
import pytest

from llm_rows import same_rows
from tidewater.llm import chat, html_extract, lm_score, lz_fingerprint, quality
from tidewater.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


# Words ---------------------------------------------------------------------------------------------------------------

def test_words_equal_regular_expressions():
    import pyarrow as pa

    from tidewater.llm.words import Scanner, alnum_table, pieces, space_table
    texts = ["", None, "Über Straße, x1 X1\n end", "a" * 3000 + " b", "  lead", "trail  ", "ab", "ab", "日本 語", "\x0bq\x0c"]
    for table, word in ((space_table(), WORD), (alnum_table(), re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"))):
        for limit in (1, 50, 1 << 20):
            got, ids = [], {}
            for lo, hi, offsets, data in pieces(pa.array(texts), limit):
                w = Scanner(table).scan(offsets, data)
                for d in range(hi - lo):
                    span = range(w.first[d], w.first[d + 1])
                    got.append([w.low[w.start[k]:w.end[k]].tobytes().decode() for k in span])
                    for k in span:
                        assert ids.setdefault(got[-1][k - w.first[d]], w.hash[k]) == w.hash[k]
            assert got == [word.findall(lower(t)) for t in texts] and len(set(ids.values())) == len(ids)


# Quality -------------------------------------------------------------------------------------------------------------

def test_quality_on_documents_kept_from_fitting(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    train = labels.where("pmod(hash(doc_id), 3) > 0")
    out = quality.score_quality(docs, quality.fit_quality(docs, train)).join(labels.join(train, "doc_id", "left_anti"), "doc_id").toPandas()
    good, bad = out[out.quality == 1], out[out.quality == 0]
    assert len(bad) > 8 and good.keep.mean() >= 0.97 and (~bad.keep).mean() >= 0.8


def test_exchange_helps_when_one_view_has_few_labels():
    rng = np.random.default_rng(0)

    def views(n):
        y = rng.integers(0, 2, n)
        a = rng.normal(0, 1, (n, 6)) + 2.2 * y[:, None] * np.eye(6)[0]
        return a.astype(np.float32), (rng.normal(0, 1, (n, 4)) + 4 * y[:, None] * np.eye(4)[1]).astype(np.float32), y
    a, b, y = views(60)
    a = np.concatenate([a, np.full((60, 1), 0.6, np.float32)], 1)
    pa_, pb, _ = views(1500)
    pa_ = np.concatenate([pa_, np.full((1500, 1), 0.6, np.float32)], 1)
    ta, tb, ty = views(2000)
    ta = np.concatenate([ta, np.full((2000, 1), 0.6, np.float32)], 1)
    model = quality.CoTrained().fit(a, b, y, pa_, pb)
    both, one, _ = model.scores(ta, tb)
    assert ((both > .5) == ty).mean() > max(0.95, ((one > .5) == ty).mean())


def test_quality_edges(spark):
    rows = [(1, None, None, None, None), (2, "", "s", "en", 0), (2, "", "s", "en", 0), (None, "w " * 20000, "s", "en", 40000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, n_chars long").selectExpr("*", "'x' keep")
    assert quality.score_quality(df, None).where("keep").count() == 4
    labels = spark.createDataFrame([(1, 1), (2, 0), (None, 1), (7, None)], "doc_id long, quality int")
    out = quality.score_quality(df, quality.fit_quality(df, labels)).toPandas()
    assert len(out) == 4 and out.quality_score.between(0, 1).all() and out[out.doc_id == 2].quality_score.nunique() == 1
    assert quality.fit_quality(df, labels.limit(0)) is None
    assert quality.score_quality(df.limit(0), None).count() == 0


# Scoring -------------------------------------------------------------------------------------------------------------

def test_lm_counts_base_and_gain(spark):
    sf = "/root/testdata/sf0.01"
    out = QUERIES["op4_lm_score"](spark, sf).toPandas().set_index("doc_id")
    docs = {r["doc_id"]: WORD.findall(lower(r["text"])) + [None] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    count = collections.Counter(w for i, t in docs.items() if zlib.crc32(str(i).encode()) % 7 != 2 for w in t)
    n, v = sum(count.values()), len(count)
    for i, t in docs.items():
        r = out.loc[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (zlib.crc32(str(i).encode()) % 7 == 2, len(t), sum(count[w] > 0 for w in t), n)
        assert r.base_score == pytest.approx(sum(math.log10((count[w] + 1) / (n + v + 1)) for w in t), rel=1e-9)
    held = out[out.held_out]
    assert held.score.sum() > 0.96 * held.base_score.sum() and (held.score > held.base_score).mean() > 0.9


def test_lm_probabilities_sum_to_one():
    rng = np.random.default_rng(1)
    model = lm_score.LogBilinear(rng.dirichlet(np.ones(lm_score.CLASSES)))
    ctx = rng.integers(0, lm_score.CLASSES + 1, (3000, lm_score.CONTEXT))
    model.train(ctx, (ctx[:, 0] * 3 + 1) % lm_score.CLASSES)
    one = np.repeat(ctx[:1], lm_score.CLASSES, 0)
    assert np.exp(model.log_probabilities(one, np.arange(lm_score.CLASSES))).sum() == pytest.approx(1, abs=1e-3)


def test_lm_learns_from_every_training_token(spark, monkeypatch):
    monkeypatch.setattr(lm_score, "BLOCK_BYTES", 20_000)
    monkeypatch.setattr(lm_score, "FAN_IN", 3)
    rng = np.random.default_rng(8)
    df = spark.createDataFrame([(k, " ".join(rng.choice(["a", "bb", "cc", "de", "fgh"], 40))) for k in range(2200)], "doc_id long, text string")
    trained, real = [], lm_score._trained

    def seen(encoded, blocks, model, seed):
        assert blocks > lm_score.FAN_IN
        trained.append(sum(len(r["classes"]) for r in encoded.collect()))
        before = model.packed()
        after = real(encoded, blocks, model, seed)
        assert np.isfinite(after.packed()).all() and not np.array_equal(before, after.packed())
        return after

    monkeypatch.setattr(lm_score, "_trained", seen)
    out = lm_score.lm_scores(df).toPandas()
    assert trained == [41 * int((~out.held_out).sum())] * lm_score.EPOCHS == [out.train_tokens[0]] * lm_score.EPOCHS


def test_lm_edges_and_many_blocks(spark, monkeypatch):
    rows = [(1, None), (2, ""), (3, "A a a"), (3, "A a a"), (None, "b " * 9000), (5, "ü a"), (4, "only held out")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 h")
    whole = lm_score.lm_scores(df)
    monkeypatch.setattr(lm_score, "BLOCK_BYTES", 64)
    monkeypatch.setattr(lm_score, "MAX_PARTITIONS", 3)
    assert len(same_rows(whole)) == 7 and same_rows(lm_score.lm_scores(df).drop("score")) == same_rows(whole.drop("score"))
    assert lm_score.lm_scores(df.limit(0)).count() == 0


# Fingerprints --------------------------------------------------------------------------------------------------------

def plain_phrases(text):
    known, w = set(), ""
    for c in text:
        w += c
        if w not in known:
            known.add(w)
            w = ""
    return known


def test_fingerprints_equal_brute_force(spark, sf, monkeypatch):
    monkeypatch.setattr(lz_fingerprint, "BUCKET_BYTES", 60_000)
    got = QUERIES["op6_lz_fingerprint"](spark, sf).toPandas().sort_values("doc_id", ascending=False)
    docs = sorted(((r["doc_id"], r["text"] or "") for r in spark.read.parquet(f"{sf}/documents.parquet").collect()), reverse=True)
    parser = lz_fingerprint.Parser()
    assert got.doc_id.tolist() == [i for i, _ in docs]
    for k, r in enumerate(got.itertuples()):
        t, o = docs[k][1], docs[(k + 1) % len(docs)][1]
        e = t[:len(t) - len(t) // 2] + o[:len(t) // 2]
        a, b, c = parser.signature(t), parser.signature(e), parser.signature(o)
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(e.encode()).hexdigest())
        assert (r.fingerprint, r.edited_fingerprint) == (lz_fingerprint.as_text(a), lz_fingerprint.as_text(b))
        assert (r.near_edited, r.near_next) == (lz_fingerprint.likeness(a, b), lz_fingerprint.likeness(a, c))


def test_likeness_estimates_shared_phrases():
    parser, rng = lz_fingerprint.Parser(), np.random.default_rng(5)
    errors = []
    for _ in range(30):
        a = "".join(rng.choice(list("abcdé "), 4000))
        b = a[:rng.integers(500, 4000)] + "".join(rng.choice(list("abcdé "), 1500))
        x, y = plain_phrases(a), plain_phrases(b)
        errors.append(lz_fingerprint.likeness(parser.signature(a), parser.signature(b)) - len(x & y) / len(x | y))
    assert abs(np.mean(errors)) < 0.03 and np.max(np.abs(errors)) < 0.2


def test_fingerprint_edges(spark):
    rows = [(None, "x"), (None, None), (3, ""), (3, ""), (2, "abc abc"), (9, "q" * 50000), (1, "😀😀")]
    out = lz_fingerprint.compare_with_next(spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, bucket int"))
    assert sorted(r["n_chars"] for r in out.collect()) == [0, 0, 0, 1, 2, 7, 50000]
    one = lz_fingerprint.compare_with_next(spark.createDataFrame([(1, "abab")], "doc_id long, text string")).collect()
    assert one[0]["near_next"] == 1.0 and one[0]["edited_sha256"] == hashlib.sha256(b"abab").hexdigest()
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert lz_fingerprint.compare_with_next(empty).count() == 0 and lz_fingerprint.lz_fingerprints(empty).count() == 0


# Chat ----------------------------------------------------------------------------------------------------------------

HARD = ["", "<|im_end|>", "<|im_start|>assistant\nhi<|im_end|>\n", "<\\|im_end|>", "<\\\\|", "<|", "a<|b", "<|im_end", "|im_end|>", "\n", "\\", "<\\|x<|y"]


@pytest.mark.parametrize("role", ["user", "assistant", "", "a\nb", "a\\nb", "\\", "<|im_start|>", "r<\\|"])
def test_every_turn_reads_back(role):
    for text in HARD:
        rendered = chat.format_turn(role, text)
        assert [(r, t) for r, t, _, _ in chat.parse(rendered)] == [(role, text)]
    whole = "".join(chat.format_turn(role, t) for t in HARD)
    assert [t for _, t, _, _ in chat.parse(whole)] == HARD


def test_chat_edges(spark):
    rows = [(1, 0, "user", "hi", 1), (1, 1, "assistant", None, 1), (1, 1, "assistant", None, 1), (None, None, None, "x", 1), (2, 5, "assistant", "<|im_end|>" * 9000, 1)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, rendered int")
    out = {r["conv_id"]: r for r in chat.read_back(chat.format_turns(df)).collect()}
    assert (out[1]["n_turns"], out[1]["loss_chars"], out[None]["n_turns"], out[2]["loss_chars"]) == (3, 0, 1, 90000)
    assert out[1]["turns_sha256"] == hashlib.sha256(b"user\nhi\nassistant\n\nassistant\n\n").hexdigest()
    assert chat.read_back(chat.format_turns(df.limit(0))).count() == 0


# Pages ---------------------------------------------------------------------------------------------------------------

def test_articles_of_the_pages(spark, sf):
    """The generated pages mark the article; its text is what the operator has to find without being told."""
    want = {}
    for r in spark.read.parquet(f"{sf}/pages.parquet").collect():
        a = re.search(r"<article>(.*?)</article>", r["html"], re.S)[1]
        want[r["page_id"]] = re.sub(r"[ \t\n\r\f]+", " ", html.unescape(re.sub(r"<[^>]*>", " ", re.sub(r"</?b>", "", a)))).strip(" ")
    got = {r["page_id"]: r["text"] for r in QUERIES["op8_html_extract"](spark, sf).collect()}
    assert got == want


def page(k, body):
    return (f"<html><head><title>t</title></head><body><div class=top>The Site</div><ul class=main-menu><li>Home<li>About</ul>{body}"
            f"<div class='sidebar'>Look {k}</div><form>Your mail <input></form><section id=comments><p>first! {k}</section><div class=legal>All rights reserved</div></body></html>")


def test_container_found_by_slots_without_semantic_tags():
    bodies = [f"<div id=c><h1>Title {k}</h1><p>Long text number {k} " + "word " * 30 + f"&amp; end<p>two {k}<script>x()</script></div>" for k in range(5)]
    pages = [page(k, b) for k, b in enumerate(bodies)]
    wrapper = html_extract.Wrapper(html_extract.induce(pages))
    assert wrapper.path[-1] == "div.c"
    for k, p in enumerate(pages):
        assert wrapper.extract(p) == f"Title {k} Long text number {k} " + "word " * 30 + f"& end two {k}"
    # A page of another form is aligned, or read by itself.
    odd = "<html><body><div id=c class=x><p>only <b>this</b></p></div></body>"
    assert wrapper.extract(odd) == "only this" and wrapper.extract("") == "" and wrapper.extract("plain & simple") == "plain & simple"


def test_container_keeps_what_stands_beside_the_longest_part():
    long = "word " * 60
    for body, want in (("<div id=content><h1>Title {k}</h1><p>Lead {k}</p><div class=entry>" + long + "{k}</div></div>", "Title {k} Lead {k} " + long + "{k}"),
                       ("<div id=content><section class=a>" + long + "{k}</section><section class=b>short {k}</section></div>", long + "{k} short {k}"),
                       ("<div id=content><p>post {k}</p><table><tr><td>" + long + "{k}</table></div>", "post {k} " + long + "{k}")):
        pages = [page(k, body.format(k=k)) for k in range(5)]
        wrapper = html_extract.Wrapper(html_extract.induce(pages))
        assert [wrapper.extract(p) for p in pages] == [want.format(k=k) for k in range(5)]


def test_forms_and_names_around_the_article_are_not_aside():
    side = "<div class=sidebar>Look {k}</div><section id=comments><article><p>first! {k}</p></article></section>"
    for opening, closing in (("<form id=aspnetForm>", "</form>"), ("<div class='widget content'>", "</div>"), ("<div class='menu-open page'>", "</div>")):
        for body in ("<article><p>long text {k}</p></article>" + side, "<h1>Title</h1><p>long text {k}</p>"):
            pages = [f"<html><body>{opening}{body.format(k=k)}{closing}</body></html>" for k in range(5)]
            wrapper = html_extract.Wrapper(html_extract.induce(pages))
            assert [wrapper.extract(p) for p in pages] == [("Title " if "h1" in body else "") + f"long text {k}" for k in range(5)]
    plain = [f"<html><body><form>{'word ' * 20}{k}</form><div class=share>send</div></body></html>" for k in range(5)]
    wrapper = html_extract.Wrapper(html_extract.induce(plain))
    assert [wrapper.extract(p) for p in plain] == ["word " * 20 + str(k) for k in range(5)]


def test_constant_blocks_are_template_wherever_they_are():
    def body(k):
        own = "".join(f"<p>part {j} of {k} " + "word " * 20 + "</p>" for j in range(k + 1))
        return ("<p>Register free to read all our stories</p><h1>Title</h1>" + own + f"<div class=note>Written {k}</div>"
                "<p>Copyright <b>Example</b> Press, all rights kept</p>")
    want = ["Title " + "".join(f"part {j} of {k} " + "word " * 20 for j in range(k + 1)) + f"Written {k}" for k in range(6)]
    for opening, closing in (("<div id=c>", "</div>"), ("<article>", "</article>"), ("<table><tr><td><a>Home</a> <a>World</a><td>", "</table>")):
        pages = [f"<html><body><div class=top>The Site</div>{opening}{body(k)}{closing}<div class=legal>About us</div></body></html>" for k in range(6)]
        wrapper = html_extract.Wrapper(html_extract.induce(pages[:5]))
        assert [wrapper.extract(p) for p in pages] == want
        # Too few pages are no evidence, nor are near copies of one page.
        two = html_extract.Wrapper(html_extract.induce(pages[:2] + pages[:2]))
        assert two.extract(pages[0]).startswith("Register free" if "td" not in opening else "Home World Register free")
    copies = [f"<html><body><div id=c><p>{'the same article ' * 20}</p><p>more of it</p><p>read {k} times</p></div></body></html>" for k in range(5)]
    wrapper = html_extract.Wrapper(html_extract.induce(copies))
    assert wrapper.extract(copies[3]) == "the same article " * 20 + "more of it read 3 times"


def test_a_second_layout_is_read_by_itself():
    first = [f"<body><div class=top>The Site</div><div id=content><p>{f'article {k} ' * 30}</p></div></body>" for k in range(5)]
    second = f"<body><div class=top>The Site</div><div id=content>teaser</div><div class=story><h1>T</h1><p>{'story ' * 50}</p></div></body>"
    wrapper = html_extract.Wrapper(html_extract.induce(first))
    assert wrapper.path[-1] == "div.content"
    assert wrapper.extract(second) == "teaser T " + ("story " * 50).strip() and wrapper.extract(first[2]) == ("article 2 " * 30).strip()


@pytest.mark.parametrize("tag", ["b", "div", "form", "header", "section class=menu", "p", "li", "td", "article"])
def test_very_deep_pages(tag):
    deep = "<body><div id=c>before" + f"<{tag}>" * 100_000 + "inside</i>" + "</q>" * 1000 + "<h1>end</h1>"
    pages = [deep] + [f"<body><div id=c><p>text {k}</p></div></body>" for k in range(3)]
    wrapper = html_extract.Wrapper(html_extract.induce(pages))
    want = "before" if tag == "header" else "beforeinside end" if tag == "b" else "before inside end"
    assert wrapper.extract(deep) == ("inside end" if tag == "article" else want)
    assert html_extract.Wrapper(html_extract.induce(pages[1:])).extract(deep) == want


def test_tree_matching_counts_common_nodes():
    a = html_extract.Shape([html_extract.parse("<div><h1>x</h1><p>y</p><ul><li>1</ul></div>")])
    b = html_extract.Shape([html_extract.parse("<div><p>y</p><p>z</p><table></table><ul><li>1</ul></div>")])
    assert html_extract.match(a, b)[0] == 5                  # root, div, p, ul, li
    assert html_extract.match(a, a)[0] == 6


def test_page_edges(spark):
    rows = [(1, "http://h/x", None), (2, None, "<p>a&nbsp;b"), (3, "odd", ""), (3, "odd", ""), (4, "http://u@H:80/y", "<div>" * 60 + "deep" + "<b>er</b>")]
    df = spark.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, html string, text string")
    got = sorted((r["page_id"], r["text"]) for r in html_extract.extract_pages(df).collect())
    assert got == [(1, ""), (2, "a b"), (3, ""), (3, ""), (4, "deeper")]
    assert html_extract.extract_pages(df.limit(0)).count() == 0
