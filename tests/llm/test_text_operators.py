"""HTML extraction, quality rules, personal data, toxicity, perplexity."""

import collections
import hashlib
import html
import math
import re
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewise.llm import html_text, kneser_ney, pii, quality_rules, toxicity
from tidewise.llm.queries import QUERIES
from tidewise.session import checkpoint_dir, scratch

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# --------------------------------------------------------------------------- html
def test_article_of_the_pages_table(spark, sf_small):
    pages = spark.read.parquet(f"{sf_small}/pages.parquet").collect()
    got = {r.page_id: r for r in QUERIES["op5_composite_density"](spark, sf_small).collect()}
    assert len(got) == len(pages)
    for p in pages:
        inner = re.search(r"<article>(.*?)(?:</article>|$)", p.html, re.S)[1]
        text = re.sub(r"</?b>", "", re.sub(r"<(?!/?b>)[^>]*>", "\n", inner))
        assert got[p.page_id].text == " ".join(html.unescape(text).split())
        assert got[p.page_id].n_chars == len(got[p.page_id].text)


PARAGRAPHS = ["The first paragraph has a good number of words &amp; a <a href='/x'>link</a> inside, as articles do.",
              "The second one is <b>bold</b>er and goes on for a while, so that its density is that of prose text.",
              "A third closes the piece with some more words about nothing in particular, but at some length."]
TEXT = " ".join(re.sub(r"<[^>]+>", "", html.unescape(p)) for p in PARAGRAPHS)
MENU = "<ul>" + "".join(f"<li><a href=/{i}>Menu entry {i}</a>" for i in range(8)) + "</ul>"


@pytest.mark.parametrize("page", [
    "<body><div class=top>{menu}</div><div id=content>{article}</div><div id=footer>Copyright 2020 Some Company</div>",
    "<div class='wrap has-sidebar'><div class=main-col>{article}</div><div class=sidebar><p>About the author of it</p>{menu}</div></div>",
    "<header><h2>Site name</h2>{menu}</header><main>{article}</main><aside>{menu}</aside><footer>Imprint</footer>",
    "{menu}<div><div><div>{article}</div></div></div><div class='comments'><p>I disagree with all of this, and I say so at"
    " length.</p><p>Me too, and I have more to say about this than anyone asked for.</p></div>",
    "<div class=cookie-consent>We use cookies. Accept all of them to go on, please.</div><article>{article}"
    "<div class=share>Share this</div></article><form><p>Subscribe to our letter<input name=q></form>",
    "<table><tr><td>{menu}</td><td>{article}</td></tr></table><script>var a = '<p>no text</p>';</script><style>p {{}}</style>",
    "<!-- <p>hidden</p> --><section>{article}</section><div role=navigation>{menu}</div><p hidden>not shown at all</p>",
])
def test_layouts(page):
    article = "".join(f"<p>{p}</p>\n" for p in PARAGRAPHS)
    assert html_text.main_text(page.format(menu=MENU, article=article)) == TEXT
    unclosed = "".join(f"<p>{p}" for p in PARAGRAPHS)
    assert html_text.main_text(page.format(menu=MENU, article=unclosed)) == TEXT


@pytest.mark.parametrize("page", [
    "<article><div class='{name}'>{article}</div></article>",
    "<main><h1 class=share></h1><section id='{name}'>{article}</section><div class=share>Share this</div></main>",
    "<form>{menu}<main><article>{article}</article></main></form>",
    "<form id=aspnet><div class=page>{article}</div></form>",
    "<div class='{name}'>{article}</div><p class=ad>Buy now</p>",
])
@pytest.mark.parametrize("name", ["entry no-sidebar", "social-policy", "with-widget", "search-results", "related", "share",
                                  "notice", "reply", "comment"])
def test_names_of_elements_that_hold_the_article(page, name):
    article = "".join(f"<p>{p}</p>\n" for p in PARAGRAPHS)
    assert html_text.main_text(page.format(menu=MENU, article=article, name=name)) == TEXT


@pytest.mark.parametrize("source, text", [
    (None, ""), ("", ""), ("no tags at all", "no tags at all"), ("<p>a<p>b<br>c", "a b c"), ("1 &lt; 2 < 3 &amp;x", "1 < 2 < 3 &x"),
    ("<p>abc <b", "abc"), ("<div><!-- open", ""), ("<p>in<b>li</b>ne  \n x</p>", "inline x"), ("</div></p>y", "y"),
    ("<script>if (a < b) x = '</p>'</script>z", "z"), ("<script>never closed", ""), ("&#233;&eacute;&amp;amp;", "éé&amp;"),
])
def test_small_pages(source, text):
    assert html_text.main_text(source) == text


def test_deep_and_long_pages():
    assert html_text.main_text("<div>" * 20_000 + "deep") == "deep"
    assert len(html_text.main_text("<p>" + "word " * 200_000)) == 5 * 200_000 - 1
    assert html_text.main_text("<a href='" + "x" * 100_000) == ""


def test_nested_and_stray_tags_take_linear_time():
    import time

    def seconds(page):
        at = time.process_time()
        html_text.main_text(page)
        return time.process_time() - at

    for unit, end in (("<div>", ""), ("<div><p>x", ""), ("<b><i>y", ""), ("<p></b></section>z ", ""), ("<ul><li>", ""), ("<div>a", "</div>")):
        seconds(unit * 2000 + end * 2000)
        small, large = (min(seconds(unit * n + end * n) for _ in range(2)) for n in (4000, 32_000))
        assert large < 24 * max(small, 0.01), unit


def _soup(r):
    """A page without telling tags, names or roles, and its article."""
    words = lambda n: " ".join("w" * r.randint(1, 9) for _ in range(n))
    links = lambda n: "".join(f"<span><a href=/{i}>{words(r.randint(1, 3))}</a></span> " for i in range(n))
    paragraphs = [words(r.randint(15, 90)) for _ in range(r.randint(3, 12))]
    inner = "".join(f"<p>{x[:40]}<i>{x[40:60]}</i>{x[60:]}</p>" for x in paragraphs)
    shown = list(paragraphs)
    if r.random() < 0.5:
        shown.insert(0, words(6))
        inner = f"<h1>{shown[0]}</h1>{inner}"
    depth = r.randint(1, 4)
    side = [f"<div><div>{links(r.randint(5, 20))}</div></div>", f"<div>{words(r.randint(4, 12))}</div>",
            f"<div>{links(3)}<div>{words(8)}</div></div>", f"<div><span>{words(5)}</span> <span>{words(4)}</span></div>"]
    r.shuffle(side)
    cut = r.randint(1, 3)
    return f"<div>{''.join(side[:cut])}{'<div>' * depth}{inner}{'</div>' * depth}{''.join(side[cut:])}</div>", " ".join(shown)


def test_density_alone_finds_the_article_of_pages_without_names(monkeypatch):
    import random

    r = random.Random(11)
    pages = [_soup(r) for _ in range(300)]
    whole = sum(html_text.main_text(p) == t for p, t in pages)
    monkeypatch.setattr(html_text.Page, "_take_out", lambda self, chosen: None)
    alone = sum(html_text.main_text(p) == t for p, t in pages)
    monkeypatch.setattr(html_text.Page, "choose", lambda self: [not out for out in self.out])
    assert alone >= 285 and whole >= alone - 3 and sum(html_text.main_text(p) == t for p, t in pages) == 0


def test_density_alone_finds_the_articles_of_the_table(spark, sf_small, monkeypatch):
    pages = [r.html for r in spark.read.parquet(f"{sf_small}/pages.parquet").select("html").collect()]
    whole = [html_text.main_text(p) for p in pages]
    monkeypatch.setattr(html_text.Page, "_take_out", lambda self, chosen: None)
    assert sum(html_text.main_text(p) == t for p, t in zip(pages, whole)) >= 0.9 * len(pages)


def test_pages_with_nulls(spark):
    df = spark.createDataFrame([(1, None, None), (None, "u", "<p>x y</p>"), (2, "u", ""), (2, "u", "")], "page_id long, url string, html string")
    got = html_text.extract(df.withColumn("text", F.lit("clash")))
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(map(str, [
        (1, None, "", 0), (None, "u", "x y", 3), (2, "u", "", 0), (2, "u", "", 0)]))
    assert html_text.extract(df.limit(0)).collect() == []


# ------------------------------------------------------------------ quality rules
def _base(t):
    t = t or ""
    w = WORD.findall(t)
    c = collections.Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    covered = {k for i in range(len(w) - 2) if c[tuple(w[i:i + 3])] > 1 for k in (i, i + 1, i + 2)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    n = len(w)
    return (n, sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered),
            n < 50 or 100 * len(covered) > 50 * n)


def _distance(p, q):
    p, q = np.array(p, float), np.array(q, float)
    if not p.sum() or not q.sum():
        return None
    p, q = p / p.sum(), q / q.sum()
    m = (p + q) / 2
    kl = lambda a: sum(x * math.log2(x / y) for x, y in zip(a, m) if x > 0)
    return math.sqrt(max((kl(p) + kl(q)) / 2, 0))


def _histograms(t, lang):
    t = t or ""
    classes = [len(re.findall(p.replace(r"\p{Lu}", "[A-ZÀ-ÖØ-Þ]"), t)) for p in quality_rules.CLASSES.values()]
    c = collections.Counter(WORD.findall(t))
    listed = quality_rules.COMMON_WORDS.get(lang, [])
    common = [c[w] for w in listed]
    return [len(t) - sum(classes), *classes], common + [sum(c.values()) - sum(common)]


def test_verdicts_equal_brute_force(docs):
    rows = [tuple(r) for r in docs.select("doc_id", "text", "lang").collect()]
    facts = {i: (_base(t), lang, *_histograms(t, lang)) for i, t, lang in rows}
    reference = {}
    for base, lang, classes, common in facts.values():
        if not base[-1] and base[0] >= quality_rules.WORD_LEAST:
            a, b = reference.setdefault(lang, (np.zeros(len(classes)), np.zeros(len(common))))
            a += classes
            b += common
    kept = 0
    for r in quality_rules.verdicts(docs).collect():
        base, lang, classes, common = facts[r.doc_id]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == base
        bad = base[-1]
        if lang in reference:
            if sum(classes) >= quality_rules.CHARACTER_LEAST:
                d = _distance(classes, reference[lang][0])
                assert abs(d - r.char_distance) < 1e-9
                bad |= d > quality_rules.CHARACTER_DISTANCE
            if base[0] >= quality_rules.WORD_LEAST and len(common) > 1:
                d = _distance(common, reference[lang][1])
                assert abs(d - r.word_distance) < 1e-9
                bad |= d > quality_rules.WORD_DISTANCE
        assert r.kept == (not bad)
        kept += r.kept
    assert 0 < kept < len(rows)


def test_quality_separates_labels(docs, labels):
    j = quality_rules.verdicts(docs).join(labels, "doc_id").filter("n_words >= 120").collect()
    assert all(r.kept for r in j if r.quality == 1 and not r.base_failed)
    assert sum(r.kept for r in j if r.quality == 0) <= 0.1 * sum(r.quality == 0 for r in j)


def test_quality_on_edge_rows(edges, edge_rows, empty, spark):
    want = sorted(((i, *_base(t)) for i, t, *_ in edge_rows), key=str)
    got = [(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
           for r in quality_rules.verdicts(edges).collect()]
    assert sorted(got, key=str) == want
    assert quality_rules.verdicts(empty).collect() == []
    # more repeated windows than the membership path takes
    many = " ".join(f"a{i % 90}" for i in range(400)) + "\nl\nl\n l\nl"
    r = quality_rules.verdicts(spark.createDataFrame([(1, many, "en", "s", 1)], edges.schema)).first()
    assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == _base(many)


# ------------------------------------------------------------------ personal data
def _base_spans(t):
    t, out = t or "", []
    for k, (name, p) in enumerate((("email", pii.EMAIL), ("ip", pii.IP), ("card", pii.CARD), ("phone", pii.PHONE))):
        for m in p.finditer(t):
            d = re.sub(r"[^0-9]", "", m[0])
            if name == "ip" and max(map(int, m[0].split("."))) > 255:
                continue
            if name == "card":
                total = sum(v - 9 * (v > 9) for v in (int(c) * (1 + j % 2) for j, c in enumerate(reversed(d))))
                if not 14 <= len(d) <= 19 or total % 10:
                    continue
            if name == "phone" and not 10 <= len(d) <= 15:
                continue
            out.append((m.start(), k, m.end(), name))
    return ",".join(f"{n}:{a}:{b}" for a, _, b, n in sorted(out))


PERSONAL = ["mail jane.d-oe+x@mail.example.co.uk, or a@b (no), x@y.z.", "10.0.0.1 256.1.1.1 1.2.3.4.5 1.2.3", "4235002738304646 4235 0027 "
            "3830 4646 4235-0027-3830-4646 4235002738304647 12345678901234567890123", "+1 (658) 555-3225 +49.30.123 456 78 +1-2 + 1 222",
            "é😀 +1 (658) 555-3225 4235002738304646 10.0.0.1 q@w.er"]


def test_base_spans_equal_brute_force(spark, docs, edges, edge_rows):
    rows = [(10**7 + i, t, "en", "s", 1) for i, t in enumerate(PERSONAL)] + edge_rows + [tuple(r) for r in docs.collect()]
    got = pii.find_spans(spark.createDataFrame(rows, edges.schema).repartition(4)).collect()
    count = lambda s: tuple(sum(x.startswith(k) for x in s.split(",")) for k in pii.KINDS)
    want = sorted(((r[0], *count(s), hashlib.sha256(s.encode()).hexdigest()) for r in rows for s in [_base_spans(r[1])]), key=str)
    assert sorted(((r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in got), key=str) == want
    assert sum(sum(count(r.spans)) for r in got) == sum(r.n_email + r.n_ip + r.n_card + r.n_phone for r in got)


def test_disclosing_terms_are_found_everywhere_and_common_words_are_not(spark, docs):
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    rows += [(10**6 + i, f"note {i} the Zzquux wrote jane.doe@example.com the thing {i * 7}") for i in range(6)]
    rows += [(10**6 + 10 + i, "the copied Yyplon has bob@example.com here") for i in range(9)]  # one context: no evidence
    rows += [(10**6 + 50, "Only zzquux é ZZquux. in here"), (10**6 + 51, "the Yyplon alone")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r.doc_id: r.spans for r in pii.find_spans(df).collect()}
    assert got[10**6 + 50] == "term:5:11,term:14:20" and got[10**6 + 51] == "" and got[10**6 + 10] == "email:22:37"
    assert "term:11:17" in got[10**6 + 3] and "term:7:10" not in got[10**6 + 3]  # zzquux, not "the"
    assert not any("term" in got[i] for i, _ in rows[:-17])
    clean = {r.doc_id: r.text for r in pii.sanitise(df.withColumn("spans", F.lit("clash")).withColumn("of", F.lit(1))).collect()}
    assert clean[10**6 + 50] == "Only [TERM] é [TERM]. in here" and clean[10**6 + 10].startswith("the copied Yyplon has [EMAIL]")
    assert all(clean[i] == t for i, t in rows if not got[i])


def test_disclosing_terms_despite_copies_few_contexts_and_long_words(spark, docs):
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    rows += [(10**6 + i, f"n{i}a the Wwcopied met jim@example.com on day{i}") for i in range(6)]
    rows += [(10**6 + 100 + i, "n0a the Wwcopied met jim@example.com on day0") for i in range(400)]
    rows += [(10**6 + 10 + i, f"m{i}b our Wwtwice sent eve@example.com a b{i}") for i in range(2)]
    rows += [(10**6 + 20 + i, f"Wwlong {'x' * 300}{i} {'y' * 300}{i} z bob@example.com c{i}") for i in range(6)]
    rows += [(10**6 + 30 + i, f"plain{i} filler{i} text") for i in range(500)]
    rows += [(10**6 + 90, "a wwcopied, a wwtwice and a wwlong")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r.doc_id: r.spans for r in pii.find_spans(df).collect()}
    assert got[10**6 + 90] == "term:2:10,term:14:21,term:28:34"
    different, n = pii.distinct_texts(df.select("text"))
    assert n == len({t for _, t in rows}) and sorted(r.text for r in different.collect()) == sorted({t for _, t in rows})


def _plain_terms(texts):
    """The docstring's statistics with sets of words, over distinct texts."""
    texts = sorted({t or "" for t in texts})
    words = lambda t: {w for w in re.findall(r"[0-9A-Za-z\x80-\U0010ffff]+", t.translate(
        {c: c + 32 for c in range(65, 91)})) if len(w.encode()) >= 3 and not w[0].isdigit()}
    n, n_t, seen = len(texts), collections.Counter(), collections.defaultdict(set)
    for t in texts:
        n_t.update(words(t))
        places = collections.defaultdict(list)
        around = [m.span() for m in re.finditer(r"\S+", t)]
        for a, kind, b in pii.base_spans(t):
            before = [t[x:min(y, a)] for x, y in around if x < a][-5:]
            after = [t[max(x, b):y] for x, y in around if y > b][:5]
            places[kind, t[a:b].lower()].append(" ".join(before + after))
        for e, parts in places.items():
            seen[e].add("\n".join(parts))
    meet = {(e, w): sum(w in words(c) for c in cs) for e, cs in seen.items() for w in set().union(*map(words, cs))}
    out = {}
    for (e, w), k in meet.items():
        total, rate, chance = len(seen[e]), k / len(seen[e]), n_t[w] / n
        share = math.log2(rate / chance) / max(math.log2(n / total), 1e-9)
        bits = k * math.log2(rate / chance) + ((total - k) * math.log2((1 - rate) / max(1 - chance, 1e-12)) if k < total else 0)
        if share >= 0.75 and bits >= math.log2(len(meet) / 0.05):
            out[w] = max(out.get(w, 0), share)
    return out


def test_pair_statistics_equal_the_formula(spark, docs):
    import random

    r = random.Random(9)
    rows = [t.text for t in docs.select("text").limit(150).collect() if len(t.text) < 20_000]
    people = [f"p{i}@mail{i % 3}.org" for i in range(8)] + ["10.1.2.3", "+49 170 1234567"]
    code = {p: f"code{chr(97 + i)}x" for i, p in enumerate(people)}
    for p in people:
        for k in range(r.randint(1, 7)):
            rows.append(" ".join(f"f{r.randint(0, 400)}q" for _ in range(6)) + f" {code[p]} {p} " + " ".join(f"g{r.randint(0, 400)}q" for _ in range(6)))
    rows += [f"zwischen{i} twice@one.org midword twice@one.org nach{i}" for i in range(1)]      # one text, two mentions
    rows += rows[-9:]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(rows)], "doc_id long, text string").repartition(4)
    want = _plain_terms(rows)
    hashes = {int(pii.signed(pii.terms_at(np.frombuffer(w.encode(), np.uint8))[0])[0]): w for w in want}
    got = {t.term: t.disclosure for t in pii.disclosing_terms(df).collect()}
    assert set(got) == set(hashes) and all(abs(got[h] - want[w]) < 1e-9 for h, w in hashes.items())
    assert want and set(want) <= set(code.values()) and "midword" not in want


def test_two_mentions_in_one_text_are_one_meeting(spark):
    """A word between two mentions of an entity has met it once."""
    rows = [(i, f"plain{i} filler{i} text") for i in range(2000)] + [
        (5000, "we asked ann@example.com about midword and ann@example.com said no"), (5001, "midword alone")]
    rows += [(6000 + k, " ".join(f"a{k}b{j}" for j in range(5)) + f" other{k}@example.com " + " ".join(f"c{k}d{j}" for j in range(5)))
             for k in range(30)]   # so many pairs that one meeting proves nothing
    got = {r.doc_id: r.spans for r in pii.find_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert "term" not in got[5000] and got[5001] == "" and got[5000].count("email") == 2


def test_personal_data_of_an_empty_table(empty):
    assert pii.find_spans(empty).collect() == []


# ----------------------------------------------------------------------- toxicity
def _labelled(n, seed, marks=("grumblefoo", "snarkbar", "vileword", "hatequx")):
    rng = np.random.default_rng(seed)
    syllables = ["ba", "ren", "ti", "lo", "mun", "the", "or", "sa", "ki", "du"]
    texts, toxic = [], []
    for i in range(n):
        w = ["".join(rng.choice(syllables, rng.integers(1, 5))) for _ in range(rng.integers(30, 200))]
        y = int(i % 4 == 0)
        if y:
            for k in rng.integers(0, len(w), rng.integers(2, 6)):
                w[k] = str(rng.choice(marks))
        texts.append(" ".join(w))
        toxic.append(y)
    return texts, toxic


def test_held_out_accuracy():
    texts, toxic = _labelled(900, 1)
    model = toxicity.train([t for t, y in zip(texts, toxic) if y], [t for t, y in zip(texts, toxic) if not y])
    texts, toxic = _labelled(400, 2)
    found = model.scores(texts, model.compressors()) >= toxicity.THRESHOLD
    truth = np.array(toxic) == 1
    assert found[truth].mean() >= 0.97 and found[~truth].mean() <= 0.02
    assert 0 <= model.scores([""], model.compressors())[0] < toxicity.THRESHOLD


def test_accuracy_on_held_out_documents(spark):
    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    got = QUERIES["op10_compression_toxicity"](spark, folder).join(labels, "doc_id").filter("held_out").collect()
    toxic, clean = [r for r in got if r.toxic == 1], [r for r in got if r.toxic == 0]
    assert sum(r.predicted for r in toxic) >= 0.85 * len(toxic)
    assert sum(r.predicted for r in clean) <= 0.03 * len(clean)


def test_toxicity_ignores_held_out_labels_and_other_columns(spark, docs, labels):
    flipped = labels.withColumn("toxic", F.when(toxicity.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    one = {tuple(r) for r in toxicity.score_documents(docs, labels).collect()}
    two = {tuple(r) for r in toxicity.score_documents(docs.withColumns({"lang": F.lit(None).cast("string"), "source": F.lit("x")}), flipped).collect()}
    assert one == two and all(h == (__import__("zlib").crc32(str(i).encode()) % 4 == 2) for i, h, *_ in one)


def test_toxicity_without_labels_and_on_edge_rows(edges, edge_rows, empty, labels, clashing):
    none = labels.limit(0)
    got = toxicity.score_documents(edges, none).collect()
    assert len(got) == len(edge_rows) and all(r.score == 0 and r.predicted == 0 for r in got)
    assert toxicity.score_documents(empty, labels).collect() == []
    kept = toxicity.reject_toxic(clashing, none)
    assert kept.columns == clashing.columns and kept.count() == len(edge_rows)


# ------------------------------------------------------------------- perplexity
def _kneser_ney(rows, trusted):
    n, counts = kneser_ney.ORDER, {}
    counts[n] = collections.Counter(f[k:k + n] for i, t in rows if i in trusted for f in [kneser_ney.flat(t)] for k in range(len(f) - n + 1))
    for o in range(n - 1, 0, -1):
        counts[o] = collections.Counter(g[1:] for g in counts[o + 1])
    cut, context = {}, {}
    for o, table in counts.items():
        n1, n2, n3, n4 = (sum(v == k for v in table.values()) for k in (1, 2, 3, 4))
        y = n1 / (n1 + 2 * n2) if n1 and n2 else 0
        cut[o] = (.5, .75, .9) if not n1 or not n2 else tuple(min(max(d, .05), k) for d, k in zip(
            (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 0), (.95, 1.95, 2.95)))
        context[o] = collections.defaultdict(lambda: [0, 0, 0, 0])
        for g, v in table.items():
            s = context[o][g[:-1]]
            s[0] += v
            s[min(v, 3)] += 1

    def p(g):
        below = p(g[1:]) if len(g) > 1 else 1 / (len(counts[1]) + 1)
        if g[:-1] not in context[len(g)]:
            return below
        total, *seen = context[len(g)][g[:-1]]
        v = counts[len(g)].get(g, 0)
        return (max(v - cut[len(g)][min(max(v, 1), 3) - 1], 0) + sum(d * k for d, k in zip(cut[len(g)], seen)) * below) / total

    assert abs(sum(p(START4 + c) for c in counts[1]) + 0 - 1) < 1e-3
    for i, t in rows:
        f = kneser_ney.flat(t)
        k = len(f) - n + 1
        yield i, k, math.exp(-sum(math.log(p(f[j:j + n])) for j in range(k)) / k)


START4 = kneser_ney.START * (kneser_ney.ORDER - 1)


@pytest.mark.parametrize("shard", [1 << 22, 15_000])
def test_perplexity_equals_brute_force(docs, labels, monkeypatch, shard):
    monkeypatch.setattr(kneser_ney, "SHARD_GRAMS", shard)
    some = docs.limit(110)
    rows = [tuple(r) for r in some.select("doc_id", "text").collect()]
    good = labels.filter("quality = 1").filter(F.pmod(F.xxhash64("doc_id"), F.lit(10)) != 0)
    want = {i: (k, p) for i, k, p in _kneser_ney(rows, {r.doc_id for r in good.collect()})}
    got = kneser_ney.perplexities(some, labels).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.n_tokens == want[r.doc_id][0] and abs(r.perplexity / want[r.doc_id][1] - 1) < 1e-9
        assert r.kept == (r.threshold is None or r.n_tokens <= kneser_ney.LEAST_CHARS or r.perplexity <= r.threshold * (1 + 1e-12))


def test_perplexity_of_many_shards_equals_brute_force(docs, labels, monkeypatch):
    monkeypatch.setattr(kneser_ney, "SHARD_TOKENS", 300)
    monkeypatch.setattr(kneser_ney, "WORD_SHARDS", 1)
    some = docs.limit(60)
    rows = [tuple(r) for r in some.select("doc_id", "text").collect()]
    words = collections.Counter(w for _, t in rows for w in kneser_ney.flat(t))
    assert words.total() > 40 * 300 and words.most_common(3)[2][1] > 300  # several are shared out
    good = labels.filter("quality = 1").filter(F.pmod(F.xxhash64("doc_id"), F.lit(10)) != 0)
    want = {i: (k, p) for i, k, p in _kneser_ney(rows, {r.doc_id for r in good.collect()})}
    got = kneser_ney.perplexities(some, labels).collect()
    assert len(got) == len(rows)
    assert all(r.n_tokens == want[r.doc_id][0] and abs(r.perplexity / want[r.doc_id][1] - 1) < 1e-9 for r in got)


def test_perplexity_tables_between_steps_stay_below_twice_the_text(docs, labels, monkeypatch):
    held, put = [], kneser_ney.Scratch.put

    def measured(self, df, name):
        table = put(self, df, name)
        held.append(sum(f.stat().st_size for f in Path(self.root.removeprefix("file:")).rglob("part-*")))
        return table

    monkeypatch.setattr(kneser_ney.Scratch, "put", measured)
    kneser_ney.perplexities(docs, labels)
    assert 0 < max(held) < 2 * docs.agg(F.sum(F.octet_length("text"))).first()[0]


def test_perplexity_separates_labels(spark):
    folder = "/root/testdata/sf0.01"
    got = QUERIES["op2_kneser_ney_perplexity"](spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").collect()
    good, bad = ([r.kept for r in got if r.quality == q] for q in (1, 0))
    assert sum(good) >= 0.98 * len(good) and sum(bad) <= 0.3 * len(bad)


def test_perplexity_on_edge_rows(edges, edge_rows, empty, labels):
    got = kneser_ney.perplexities(edges, labels.limit(0)).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(r[0]) for r in edge_rows)
    assert all(r.kept and r.threshold is None and r.perplexity > 0 for r in got)
    assert {r.n_tokens for r in got if r.doc_id in (3, 4, 5)} == {1}
    assert kneser_ney.perplexities(empty, labels).collect() == []


def test_perplexity_models_word_order(spark):
    rng = np.random.default_rng(3)
    parts = [["the old", "a small", "this"], ["house", "river", "engine"], ["stands near", "was seen from", "belongs to"],
             ["the town", "a wide valley", "our neighbours"], ["and so", "but often", "while"]]
    prose = [" ".join(str(rng.choice(p)) for _ in range(20) for p in parts) for _ in range(60)]
    mixed = [" ".join(rng.permutation(t.split())) for t in prose[50:]]
    df = spark.createDataFrame([(i, t, "en") for i, t in enumerate(prose + mixed)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1) for i in range(50)], "doc_id long, quality int")
    got = {r.doc_id: r for r in kneser_ney.perplexities(df, labels).collect()}
    assert all(got[i].n_tokens == len(t.split()) + 1 for i, t in enumerate(prose + mixed))
    worst = max(got[i].perplexity for i in range(60))
    assert all(got[i].perplexity > 3 * worst for i in range(60, 70))
    assert not any(got[i].kept for i in range(60, 70))


def test_perplexity_leaves_one_small_row_per_document_on_disk(spark, docs, labels):
    folder, setting = Path(checkpoint_dir(spark).removeprefix("file:")), "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, was = set(folder.rglob("part-*")), spark.conf.get(setting)
    result = kneser_ney.perplexities(docs, labels)
    left = set(folder.rglob("part-*")) - before
    assert 0 < sum(f.stat().st_size for f in left) < 200 * docs.count() + 10_000
    assert not list(folder.glob("tables/kneser_ney/*")) and spark.conf.get(setting) == was
    assert result.count() == result.count() == docs.count()


def test_scratch_tables_go_when_a_step_fails(spark):
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was = spark.conf.get(setting)
    with pytest.raises(ZeroDivisionError), scratch(spark, "failing") as tables:
        a = tables.put(spark.range(5), "a")
        assert a.count() == 5 and tables.put(spark.range(3), "a").count() == 8
        assert tables.put(spark.range(0), "b").count() == 0
        tables.drop("b")
        assert [f.name for f in Path(tables.root.removeprefix("file:")).iterdir()] == ["a"]
        1 / 0
    assert not Path(tables.root.removeprefix("file:")).exists() and spark.conf.get(setting) == was


def test_ngram_keys_are_sparks_hashes(spark):
    words = np.random.default_rng(5).integers(-1 << 63, 1 << 63, (50, 3))
    df = spark.createDataFrame([[int(x) for x in w] for w in words], "a long, b long, c long")
    for n in (1, 2, 3):
        want = [r[0] for r in df.select(F.xxhash64(*df.columns[:n])).collect()]
        assert kneser_ney._keys(list(words.view(np.uint64).T[:n])).view(np.int64).tolist() == want


def test_nothing_is_rejected_without_labels_of_both_kinds(spark, docs, labels):
    only = labels.filter("toxic = 1")
    assert toxicity.reject_toxic(docs, only).count() == docs.count()
    few = labels.filter("toxic = 0").limit(5).union(labels.filter("toxic = 1").limit(3))
    assert toxicity.fit(docs.limit(0), few).share == few.filter(~toxicity.held_out()).agg({"toxic": "avg"}).first()[0]


def test_training_is_the_same_in_every_process():
    import subprocess
    import sys

    code = ("import hashlib; from tidewise.llm import toxicity as t; "
            "texts = [' '.join(f'w{(i * 7 + j * j) % 50}' + ('vile' * (i % 3 == 0 and j == 3)) for j in range(60)) for i in range(60)]; "
            "m = t.train(texts[::3], texts[1::3] + texts[2::3]); print(hashlib.sha256(m.toxic + m.ordinary + m.weights.tobytes()).hexdigest())")
    seen = {subprocess.run([sys.executable, "-c", code], env={**__import__("os").environ, "PYTHONHASHSEED": seed}, text=True,
                           capture_output=True, check=True).stdout for seed in ("1", "2")}
    assert len(seen) == 1
