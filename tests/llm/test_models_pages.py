"""Classifiers, pages, personal data, mixing, decontamination and the pipeline."""

import hashlib
import heapq
import random
import re
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tarmac.llm import decontam, html, learn, mixing, pii, quality, textnum, toxicity

SF = "/root/testdata/sf0.01"


def held(doc_id, modulus):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % modulus


def prose(r, n, extra=()):
    words = ["the", "of", "and", "river", "stone", "walks", "slowly", "green", "house", "on", "was", "near", "old"]
    out = [r.choice(words) for _ in range(n)]
    for w in extra:
        out.insert(r.randrange(len(out) + 1), w)
    return " ".join(out)


@pytest.mark.parametrize(
    "model, label, modulus, fold", [(toxicity, "toxic", 5, 0), (quality, "quality", 3, 1)], ids=["toxicity", "quality"]
)
def test_classifier_on_held_out_rows(spark, documents, odd, clashing, model, label, modulus, fold):
    r = random.Random(4)
    bad = ["grumblefoot", "snarkling", "vexwort"]
    rows, marks = [], []
    for i in range(100, 400):
        flag = i % 3 == 0
        if label == "toxic":
            text = prose(r, r.randint(5, 60), [r.choice(bad) + r.choice(["", "s", "ish"])] * flag)
        else:
            text = prose(r, 50) if flag else " ".join(w.upper() + "$$" for w in prose(r, 50).split())
        rows.append((i, text))
        marks.append((i, int(flag), int(flag)))
    labels = spark.createDataFrame([*marks, (None, 1, 1), (1, 0, 0), (9999, 1, 1)], "doc_id long, quality int, toxic int")
    got = model.classify(documents([*odd, *rows], clashing), labels).collect()
    assert len(got) == len(odd) + len(rows)
    truth = {i: flag for i, flag, _ in marks}
    for g in got:
        assert 0 <= g["score"] <= 1 and g["predicted"] == int(g["score"] >= 0.5)
        assert g["held_out"] == (held(g["doc_id"], modulus) == fold)
    test = [g for g in got if g["held_out"] and g["doc_id"] in truth]
    assert np.mean([g["predicted"] == truth[g["doc_id"]] for g in test]) >= 0.95
    again = model.classify(documents([*odd, *rows]), labels).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, map(tuple, again)))


@pytest.mark.parametrize("model", [toxicity, quality], ids=["toxicity", "quality"])
def test_classifier_never_reads_held_out_labels(spark, documents, model):
    modulus, fold = (5, 0) if model is toxicity else (3, 1)
    r = random.Random(6)
    rows = [(i, prose(r, 30, ["vexwort"] * (i % 2))) for i in range(200)]
    labels = [(i, i % 2, i % 2) for i in range(200)]
    flipped = [(i, 1 - q if held(i, modulus) == fold else q, 1 - t if held(i, modulus) == fold else t) for i, q, t in labels]
    schema = "doc_id long, quality int, toxic int"
    one = model.classify(documents(rows), spark.createDataFrame(labels, schema)).collect()
    two = model.classify(documents(rows), spark.createDataFrame(flipped, schema)).collect()
    assert sorted(one) == sorted(two)


@pytest.mark.parametrize("model", [toxicity, quality], ids=["toxicity", "quality"])
def test_classifier_without_rows_or_labels(spark, documents, model):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert model.classify(documents([]), none).count() == 0
    assert {r["score"] for r in model.classify(documents([(1, "a b"), (2, None)]), none).collect()} == {0.5}


def test_toxic_accuracy_on_the_table(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    got = quality.classify(docs, labels).filter("held_out").join(labels, "doc_id")
    assert got.filter("predicted = quality").count() / got.count() >= 0.95


def test_toxicity_learns_from_every_labelled_text(spark, documents, monkeypatch):
    r = random.Random(8)
    rows = [(i, prose(r, 7600, ["vexwort"] * 300 * (i % 3 == 0))) for i in range(60)]
    assert min(len(t) for _, t in rows) > 1 << 15  # longer than any text that was once learned from
    labels = [(i, 1, int(i % 3 == 0)) for i in range(60)]
    monkeypatch.setattr(learn, "SHARD_ROWS", 30)
    monkeypatch.setattr(learn, "PART_BYTES", 1 << 18)
    monkeypatch.setattr(toxicity, "PIECE", 1000)
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = toxicity.classify(documents(rows), known).collect()
    assert all(g["predicted"] == (g["doc_id"] % 3 == 0) for g in got)
    again = {g["doc_id"]: g["score"] for g in toxicity.classify(documents(rows).repartition(7), known).collect()}
    assert all(abs(again[g["doc_id"]] - g["score"]) < 0.02 for g in got)


def test_words_are_counted_over_all_texts(spark, documents):
    n = 6600  # more than were once sampled; each rare word is in exactly MIN_TEXTS of them
    rows = [(i, f"common rare{chr(97 + i // 26 % 26)}{chr(97 + i % 26)}" if i < 26 * 26 * toxicity.MIN_TEXTS else "common") for i in range(n)]
    labels = spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i in range(n)], "doc_id long, quality int, toxic int")
    learned = learn.labelled_shards(documents(rows), labels, "toxic", textnum.fold(F.col("doc_id"), 5) != 9, toxicity._sequences, "ids binary, language int")
    assert learned.count() == n
    known = toxicity._known_words(learned, {0: 2000, 1: 2000})
    of = lambda word: known[toxicity._slot(toxicity._hash_words([word]))[0]]
    assert of("common") and all(of(f"rare{chr(97 + a)}{chr(97 + b)}") for a in range(26) for b in range(26))
    assert not of("vexwort")


PAGE = """<!DOCTYPE html><html><head><title>no</title><script>if (a < b) "</p>"</script></head><body>
<header class="masthead"><h1>Site</h1></header><nav><ul><li><a href="/">Menu</a></li></ul></nav>
<div class="cookie-notice">We set cookies and more cookies than you would like to read about here</div>
<div id="w"><article class="post post-%d"><header><h1>Title &amp; %d</h1></header><!-- x --><p>One<br>two <i>th</i>ree&nbsp;four &#x41;&eacute;
<p>Five <b>six</b><div class="ad-box">Buy now</div><form><p>Name</p></form><ul><li>seven<li>eight</ul></article>
<aside>Side</aside><section class="comments"><article class="comment"><p>A reader says a great deal more than the article</p></article></section></div>
<footer>&copy; foot</footer></body></html>"""


def test_pages_of_a_host(spark):
    rows = [(i, f"https://Blog.example.com:80/{i}", PAGE % (i, i)) for i in range(8)]
    rows += [
        (20, None, None), (21, "x", ""), (22, "https://blog.example.com/z", "<p>only a paragraph"), (22, "https://blog.example.com/z", "<p>only a paragraph"),
        (23, "https://blog.example.com/q", "no markup at < all &lt;b&gt;"), (24, "https://o.example", "<div " + "x" * 50000), (25, "https://o.example", "<" * 3000),
        (26, "https://o.example", "<div class='a'><p>" + "long " * 40000 + "</p></div>"),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' AS host", "'y' AS text", "1 AS paths")
    got = {}
    for r in html.main_text(pages).collect():
        assert r["n_chars"] == len(r["text"])
        got.setdefault(r["page_id"], []).append(r["text"])
    for i in range(8):
        assert got[i] == [f"Title & {i} One two three four Aé Five six seven eight"]
    assert got[20] == got[21] == [""] and got[22] == ["only a paragraph"] * 2
    assert got[23] == ["no markup at < all <b>"] and got[26] == [("long " * 40000).strip()]
    assert sum(map(len, got.values())) == len(rows)


@pytest.mark.parametrize("limit", [1 << 20, 0])
def test_host_consensus_beats_a_page_own_best(spark, monkeypatch, limit):
    monkeypatch.setattr(html, "BROADCAST_BYTES", limit)
    usual = "<body><div class='story'><p>{}</p></div><div class='extra'><p>short</p></div></body>"
    odd_one = "<body><div class='story'><p>tiny</p></div><div class='extra'><p>" + "filler " * 50 + "</p></div></body>"
    rows = [(i, "http://h.org/", usual.format("real text of some length " * 3)) for i in range(6)] + [(9, "http://h.org/", odd_one)]
    got = html.main_text(spark.createDataFrame(rows, "page_id long, url string, html string"))
    assert got.filter("page_id = 9").first()["text"] == "tiny"


def test_attribute_values_are_not_names():
    shown = "<div style='overflow: hidden' title=\"The hidden cost\" data-x=hidden data-y='a class=\"ad\" b'><p>kept text</p></div>"
    gone = "<div class='a'hidden><p>one</p></div><div HIDDEN=''><p>two</p></div><div aria-hidden=true><p>three</p></div>"
    assert html.extract(f"<body>{shown}{gone}<div aria-hidden=false><p>x</p></div></body>", ["/body"]) == "kept text x"


def test_whole_article_around_a_dominant_child():
    parts = "<h1>The heading here</h1><div class='lead'><p>" + "lead " * 40 + "</p></div><div class='body'><p>" + "body " * 400 + "</p></div>"
    whole = "The heading here " + "lead " * 40 + ("body " * 400).strip()
    cells = "<table><tr><td>" + "cell " * 300 + "</td></tr></table><p>" + "after " * 60 + "</p>"
    for page, text in [
        (f"<body><nav>menu</nav><article>{parts}</article></body>", whole),
        (f"<body><nav>menu</nav><div class='post'>{parts}</div><div><p>x</p></div></body>", whole),
        (parts, whole),
        (f"<main>{cells}</main>", "cell " * 300 + ("after " * 60).strip()),
    ]:
        assert html.extract(page, [html.best_path(page)]) == text


def test_hosts_with_two_templates(spark):
    first, second = "<body><div class='a'><p>{}</p></div><div class='b'><p>{}</p></div></body>", "words of the text " * 9
    rows = [(i, "http://two.org/", first.format(second, "")) for i in range(8)] + [(10 + i, "http://two.org/", first.format("tag", second)) for i in range(4)]
    got = {r["page_id"]: r["text"] for r in html.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert set(got.values()) == {second.strip()}


def test_names_that_only_begin_like_a_skipped_one():
    page = (
        "<body><article><p>Opening words.</p><section class='social-impact'><p>Impact on people.</p></section><div id='legal-analysis'>"
        "<p>Of the law.</p></div><div class='related-reading'><a href='/'>Read this</a></div><div class='ad-box'>Buy</div>"
        "<p>Let <math><mi>x</mi><mspace/></math> be.</p><object><p>Object text.</p></object>"
        "<div><svg><text>drawn</div><p>After svg.</p><div><select><option>pick</div><p>After <svg/>select.</p></article></body>"
    )
    got = html.extract(page, [html.best_path(page)])
    assert got == "Opening words. Impact on people. Of the law. Let x be. Object text. After svg. After select."


def test_articles_of_the_table(spark):
    from html import unescape

    pages = spark.read.parquet(f"{SF}/pages.parquet")
    got = {r["page_id"]: r["text"] for r in html.main_text(pages).collect()}
    for r in pages.collect():
        inner = re.search(r"<article>(.*)</article>", r["html"], re.S)[1]
        assert got[r["page_id"]] == " ".join(unescape(re.sub(r"</?b>", "", re.sub(r"</?(p|h1|br)>", " ", inner))).split())


def test_no_pages(spark):
    assert html.main_text(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


KINDS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def accepted(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 9 <= len(digits) <= 15


def base(text):
    return {k: [m.span() for m in re.finditer(p, text or "") if accepted(k, m[0])] for k, p in KINDS.items()}


HARD = [
    "a@b.c_d@e.f.g@h.i", "1.2.3.4.5.6.7.8.9", "300.1.1.1 0255.1.1.1 000000000000000255.1.1.1 99999999999.1.1.1",
    "4111 1111-1111 1111 4111  1111 1111 1111", "+1 (988) 555-2485)) ++1 234-567-890 +12.", "😀é +4915112345678 x@y.zz 4111111111111111,",
    "@@.@a.b", "x" * 3000 + "@q" + ".r" * 50, "0" * 40, "5.5.5.5@6.6.6", "%%a.b@c-d.e-f...g@h.i", "9" * 20000, "a1" * 20000,
]


def test_base_spans(documents, odd, clashing):
    rows = [*odd, *[(100 + i, t) for i, t in enumerate(HARD)]]
    got = pii.find(documents(rows, clashing)).collect()
    expected = []
    for i, t in rows:
        spans = base(t)
        listed = ",".join(f"{k}:{a}:{b}" for k in KINDS for a, b in spans[k])
        expected.append((i, *[len(spans[k]) for k in KINDS], hashlib.sha256(listed.encode()).hexdigest(), listed))
    assert sorted(str(tuple(r)[:6]) for r in got) == sorted(str(e[:6]) for e in expected)
    assert all(r["spans"].startswith(e[6]) for r in got for e in expected if e[0] == r["doc_id"] and e[0] and e[0] >= 100)


def test_contexts_discover_unseen_identifiers(documents):
    rows = [(i, f"please contact user{i}@mail.example about it") for i in range(12)]
    rows += [(50, "please contact QX77-AB41 about it"), (51, "the part QX77-AB41 is blue and room B4410 too"), (51, "the part QX77-AB41 is blue and room B4410 too")]
    got = {r["doc_id"]: r for r in pii.find(documents(rows)).collect()}
    assert got[50]["spans"] == "id:15:24" and got[51]["spans"] == "id:9:18"
    assert got[3]["spans"] == got[3]["spans"].split(",")[0] and got[3]["n_email"] == 1


def test_contexts_beyond_symbols_and_on_the_right(documents):
    rows = [(i, f'the token = "user{i}@mail.example"') for i in range(12)] + [(50, 'the token = "QX77AB41"'), (51, 'token="QX88AB41"')]
    rows += [(100 + i, f"10.0.0.{i} connected now") for i in range(20)] + [(150, "ZZ99-KK1 | connected again")]
    got = {r["doc_id"]: r for r in pii.find(documents(rows)).collect()}
    assert got[50]["spans"] == "id:13:21" and got[51]["spans"] == "id:7:15" and got[150]["spans"] == "id:0:8"


def test_discovered_identifiers_vouch_for_further_contexts(documents):
    rows = [(i, f"please contact user{i}@mail.example about it") for i in range(60)]
    rows += [(100 + i, f"please contact QX{i}77-AB41 about it") for i in range(12)]
    rows += [(200 + i, f"his account QX{i}77-AB41 was closed") for i in range(12)] + [(300, "his account ZK-90417 was closed")]
    got = {r["doc_id"]: r for r in pii.find(documents(rows)).collect()}
    assert got[100]["n_id"] == got[200]["n_id"] == 1 and got[300]["spans"] == "id:12:20"


def test_identifiers_without_letters_or_digits(documents):
    rows = [(i, f"please contact user{i}@mail.example about it") for i in range(60)]
    odd_ones = ["555-123-4567", "123-45-6789", "40017223", "4111111111111112", "john.doe", "night_owl"]
    rows += [(100 + i, f"please contact {v} about it") for i, v in enumerate(odd_ones)] + [(200, "see john.doe, or see jane.roe")]
    got = {r["doc_id"]: r for r in pii.find(documents(rows)).collect()}
    assert [got[100 + i]["spans"] for i in range(6)] == [f"id:15:{15 + len(v)}" for v in odd_ones]
    assert got[200]["spans"] == "id:4:12"
    masked = {r["doc_id"]: r["text"] for r in pii.mask(documents(rows)).collect()}
    assert masked[100] == masked[104] == "please contact [ID] about it" and masked[200] == "see [ID], or see jane.roe"


def test_mask_replaces_spans_and_keeps_columns(documents, odd, clashing):
    rows = [*odd, (100, "mail a@b.cc, 😀 call +1 234 567 8901 or 10.0.0.1"), (101, "1.2.3.4@example.org")]
    docs = documents(rows, clashing)
    got = pii.mask(docs)
    assert got.columns == docs.columns and got.count() == len(rows)
    texts = {r["doc_id"]: r["text"] for r in got.collect()}
    assert texts[100] == "mail [EMAIL], 😀 call [PHONE] or [IP]" and texts[101] == "[EMAIL]"
    assert texts[1] is None and texts[2] == "" and texts[8] == "word " * 30000
    assert pii.mask(documents([])).count() == 0 and pii.find(documents([])).count() == 0


def fill(sizes):
    """Targets by resharing the excess until no source is above three times its size."""
    order = sorted(s for s in sizes if s is not None) + [None] * (None in sizes)
    weight = {s: k % 3 + 1 for k, s in enumerate(order)}
    total, full = sum(sizes.values()), set()
    while True:
        free = [s for s in order if s not in full]
        level = (total - sum(3 * sizes[s] for s in full)) / max(sum(weight[s] for s in free), 1)
        above = {s for s in free if level * weight[s] > 3 * sizes[s]}
        if not above:
            return {s: 3 * sizes[s] if s in full else level * weight[s] for s in order}
        full |= above


@pytest.mark.parametrize("shard", [2000, 5])
def test_mix(documents, odd, clashing, monkeypatch, shard):
    monkeypatch.setattr(mixing, "SHARD_ROWS", shard)
    r = random.Random(2)
    rows = [(*x, "odd") for x in odd]
    for s, n in [("é", 4), ("z", 90), ("Z", 30), (None, 12), ("", 3), ("empty", 2)]:
        rows += [(r.randrange(1000), " ".join(["w"] * r.randint(0, 90)) if s != "empty" else None, s) for _ in range(n)]
    got = mixing.mix(documents(rows, [c for c in clashing if c != "source"])).collect()
    again = mixing.mix(documents(rows)).collect()
    assert len(got) == len(rows) and sorted(map(str, got)) == sorted(map(str, again))
    sizes = {}
    for _, text, s in rows:
        sizes[s] = sizes.get(s, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    want = fill(sizes)
    for s in sizes:
        own = [g for g in got if g["source"] == s]
        assert {g["source_size"] for g in own} == {sizes[s]} and sum(g["size"] for g in own) == sizes[s]
        assert all(abs(g["target"] - want[s]) < 1e-6 for g in own)
        assert abs(sum(g["taken"] for g in own) - want[s]) <= max(3, 0.01 * want[s])
    assert all(0 <= g["taken"] <= 3 * g["size"] for g in got)
    assert mixing.mix(documents([])).count() == 0


def test_small_sources_are_mixed_whatever_the_size(documents, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCKS", 8)
    rows = [(i, "w " * 100, "a") for i in range(30)] + [(100, "w " * 30, "b"), (101, "", "c")]
    got = mixing.mix(documents(rows)).collect()
    for source in "abc":
        own = [r for r in got if r["source"] == source]
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= own[0]["target"] / 16


def highest_quotients(votes, seats):
    """Seats by listing quotients in a heap; ties go to the lower party."""
    heap = [(-v, p, 0) for p, v in enumerate(votes) if v > 0]
    heapq.heapify(heap)
    won = [0] * len(votes)
    for _ in range(seats if heap else 0):
        _, p, k = heapq.heappop(heap)
        won[p] += 1
        heapq.heappush(heap, (-votes[p] / (2 * k + 3), p, k + 1))
    return won


def test_sainte_lague_is_highest_quotients(spark):
    r = random.Random(9)
    cases = [([r.choice([0, 1, 7, 50, 333, 1000]) + r.random() for _ in range(6)], r.randint(0, 60)) for _ in range(6)]
    cases += [
        ([16.45] * 1999 + [1_000_000.0], 1_002_000),  # one party far above many
        ([2.4] * 999 + [2500.0], 2000),
        ([5.0] * 40, 17),  # ties alone
        ([3.0, 0.0, 1.0], 0),
        ([0.0, 0.0], 5),
        ([1e-3, 1e9, 7.0], 11),
        ([float(r.randint(1, 9)) for _ in range(300)], 40),  # more parties than seats
    ]
    rows = [(None if g == 3 else f"g{g}", k, v, seats) for g, (votes, seats) in enumerate(cases) for k, v in enumerate(votes)]
    df = spark.createDataFrame(rows, "g string, p int, v double, n long")
    got = mixing.sainte_lague(df, "g", "v", "n", "p").collect()
    found = {(r["g"], r["p"]): r["blocks"] for r in got}
    assert len(got) == len(rows)
    for g, (votes, seats) in enumerate(cases):
        name = None if g == 3 else f"g{g}"
        assert [found[name, p] for p in range(len(votes))] == highest_quotients(votes, seats), g
    alone = mixing.sainte_lague(df.filter("g = 'g0'"), None, "v", "n", "p").collect()
    assert {r["p"]: r["blocks"] for r in alone} == {p: found["g0", p] for p in range(6)}


@pytest.mark.parametrize(
    "page, path, text",
    [
        ("<div>x " * 50_000, "/div", "x " * 50_000),
        ("<font>x " * 50_000, "", "x " * 50_000),
        ("<div>" * 50_000 + "x</section>" * 50_000, "/div" * 50_000, "x " * 50_000),
        ("<main>" + "<div class='share-a'>x " * 50_000, "/main", "x " * 50_000),
        ("<body>" + "<b>" * 50_000 + "x" + "</i>" * 50_000, "/body", "x"),
    ],
)
def test_pages_nested_very_deep_take_memory_by_their_size(page, path, text):
    tracemalloc.start()
    got = html.best_path(page)
    shown = html.extract(page, [got])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got == path and shown == text.strip()
    assert peak < 150 << 20


def test_wanted_paths_are_told_apart_whatever_their_classes():
    page = "<body><div class='w-a/div'><p>one</p></div><div class=w-a><div><p>two</p></div></div><div class='w-ab'>three</div></body>"
    assert html.extract(page, ["/body/div.w-a/div"]) == "one two"  # one path in writing
    assert html.extract(page, ["/body/div.w-a"]) == "two"
    assert html.extract(page, ["/body/div.w-ab", "/body/div.w-a"]) == "three"


def brute_tiles(item, doc):
    """Greedy string tiling by trying every pair of places each time."""
    free_i, free_d, tiles = [True] * len(item), [True] * len(doc), []
    while True:
        best = (0, 0, 0)
        for a in range(len(item)):
            for b in range(len(doc)):
                n = 0
                while a + n < len(item) and b + n < len(doc) and free_i[a + n] and free_d[b + n] and item[a + n] == doc[b + n]:
                    n += 1
                if n > best[2]:
                    best = (a, b, n)
        if best[2] < decontam.SEED:
            return tiles
        a, b, n = best
        free_i[a : a + n] = [False] * n
        free_d[b : b + n] = [False] * n
        tiles.append(best)


@pytest.mark.parametrize("seed", range(8))
def test_tiles_equal_brute_force(seed):
    r = random.Random(seed)
    item = [r.randrange(1, 4) for _ in range(40)]
    doc = item[25:] + [9] + item[:20] + [r.randrange(1, 4) for _ in range(30)]
    i, j = zip(*[(a, b) for a in range(len(item) - 4) for b in range(len(doc) - 4) if item[a : a + 5] == doc[b : b + 5]])
    got = decontam.tile(np.array(item, np.uint64), np.array(doc, np.uint64), np.array(i), np.array(j))
    assert got == brute_tiles(item, doc)


@pytest.mark.parametrize("seed", range(12))
def test_tiles_by_length_equal_brute_force(seed):
    r = random.Random(seed)
    letters = 1 + seed % 4  # one letter alone: all windows are alike
    item = [r.randrange(letters) for _ in range(r.randrange(5, 50))]
    doc = item[25:] + [9] * r.randrange(2) + item[:20] + [r.randrange(letters) for _ in range(r.randrange(60))]
    item, doc = (np.array(x, np.uint64) for x in (item, doc))
    free = np.zeros(len(doc), bool)
    for b in range(len(doc) - 4):
        if any((item[a : a + 5] == doc[b : b + 5]).all() for a in range(len(item) - 4)):
            free[b : b + 5] = True
    assert decontam.tile_by_length(item, doc, free) == brute_tiles(item, doc)


def test_leaks_do_not_depend_on_how_matches_are_searched(monkeypatch):
    r = random.Random(3)
    words = [f"w{k}" for k in range(6)]
    items = [(k, " ".join(r.choice(words[: 1 + k % 6]) for _ in range(r.randrange(1, 60)))) for k in range(40)]
    texts = [" ".join(r.choice(words[: 1 + k % 6]) for _ in range(r.randrange(0, 200))) for k in range(60)]
    texts += [items[5][1] + " x " + items[9][1], items[11][1]]
    index, results = decontam.build_index(items), []
    for pairs, expanded in ((1 << 16, 1 << 20), (0, 1), (40, 300), (1 << 16, 1)):
        monkeypatch.setattr(decontam, "SEED_PAIRS", pairs)
        monkeypatch.setattr(decontam, "EXPANDED", expanded)
        results.append([(c.first + k, *x) for c in textnum.chunks(pa.array(texts)) for k, *x in decontam.chunk_leaks(c, index, 0.5)])
    assert len(results[0]) > 40 and all(sorted(x) == sorted(results[0]) for x in results)


def test_a_text_of_one_token_against_such_an_item_takes_little_memory():
    index = decontam.build_index([(1, "0 " * 200), (2, "0 1 " * 300)])
    texts = ["0 " * 500_000, "0 1 " * 100_000, *["0 0 0 0 0 0"] * 4_000]
    tracemalloc.start()
    got = [x for c in textnum.chunks(pa.array(texts)) for x in decontam.chunk_leaks(c, index, 0.5)]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [(k, n, tiled) for _, k, n, tiled in got] == [(0, 1, 200), (1, 1, 600)]
    assert peak < 300 << 20


def test_reordered_leaks_are_found(spark, documents, odd, clashing):
    words = [f"w{k}" for k in range(30)]
    shuffled = words[20:] + ["and"] + words[10:20] + ["or"] + words[:10]
    rows = [
        *odd, (50, "x " * 300 + " ".join(words) + " y" * 300), (51, " ".join(shuffled).upper() + "!"), (51, " ".join(shuffled)),
        (52, " ".join(words[:14])), (53, " ".join(words[:15])), (54, "w1 w3 w5 " * 50), (55, ", ".join(words)),
    ]
    bench = spark.createDataFrame([(7, " ".join(words)), (8, "too short"), (9, None), (10, "")], "item_id long, text string")
    docs = documents(rows, clashing)
    for size in (1 << 20, 60):
        got = decontam.leaks(docs, bench, block_bytes=size).collect()
        assert sorted((r["doc_id"], r["item_id"]) for r in got) == [(50, 7), (51, 7), (51, 7), (53, 7), (55, 7)]
        assert {r["doc_id"]: r["n_tiles"] for r in got}[51] == 3
        kept = decontam.clean(docs, bench, block_bytes=size)
        assert kept.columns == docs.columns
        assert sorted(map(str, (r["doc_id"] for r in kept.collect()))) == sorted(str(i) for i, _ in rows if i not in (50, 51, 53, 55))
    none = bench.limit(0)
    assert decontam.leaks(docs, none).count() == 0 and decontam.clean(docs, none).count() == len(rows)
    assert decontam.leaks(documents([]), bench).count() == 0


def test_short_items_and_scripts_without_spaces(spark, documents):
    said = "今日は天気がいいから散歩しましょう"
    items = [(1, "Short, item"), (2, "one"), (3, said), (4, "ประเทศไทยรวมเลือด"), (5, "𠀀𠀁𠀂"), (6, "item one")]
    rows = [
        (1, "a short item here"), (2, "short"), (3, "item here is short"), (4, "昨日、彼は" + said + "と言った。"), (5, said[:4]), (6, "วันนี้ประเทศไทยรวมเลือดเนื้อ"),
        (7, "前𠀀𠀁𠀂後"), (8, None), (9, "ONE item"), (10, "one, one one"), (11, "今日は、天気がいいから。"),
    ]
    docs, bench = documents(rows), spark.createDataFrame(items, "item_id long, text string")
    got = sorted((r["doc_id"], r["item_id"], r["coverage"] == 1.0) for r in decontam.leaks(docs, bench).collect())
    assert got == [(1, 1, True), (4, 3, True), (6, 4, True), (7, 5, True), (9, 2, True), (10, 2, True), (11, 3, False)]
    assert sorted(r["doc_id"] for r in decontam.clean(docs, bench).collect()) == [2, 3, 5, 8]


def test_pipeline_stages_work_on_what_is_kept(spark, tmp_path):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_classifier", "simhash_near_dedup", "benchmark_decontamination", "personal_data", "source_mix",
    ]
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, sf).write.parquet(str(tmp_path / name))
        after = spark.read.parquet(str(tmp_path / name))
        assert 0 < after.count() <= before
        if k < 4:
            assert after.columns == columns
            if name != "personal_data":
                assert after.join(docs, columns, "left_semi").count() == after.count()
        docs, before = after, after.count()
    run = corpus_pipeline.run(spark, sf)
    assert sorted(map(tuple, run.collect())) == sorted(map(tuple, docs.collect()))
    assert corpus_pipeline.ORACLE_SQL is None


def test_stages_on_odd_rows(spark, documents, odd, clashing):
    sf = "/root/testdata/sf0.001"
    names = [c for c in clashing if c not in ("taken",)]
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, documents([]), sf).count() == 0, name
        docs = documents(odd, names)
        out = stage(spark, docs, sf)
        assert out.count() <= len(odd), name
        if name != "source_mix":
            assert out.columns == docs.columns, name


def test_spans_of_a_text_of_very_many_numbers(documents):
    """Places are found in runs: the time grows with the text, not with its square."""
    import time

    r = random.Random(2)
    words = [f"{r.randrange(10**9)}" if k % 3 else f"+49 170 {r.randrange(10**7):07d}" for k in range(60_000)]
    text = " x ".join(words)
    began = time.time()
    (row,) = pii.find(documents([(1, text)])).collect()
    assert time.time() - began < 120
    assert row["n_phone"] == 20_000
    phone = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
    spans = [f"phone:{m.start()}:{m.end()}" for m in phone.finditer(text) if 9 <= sum(c.isdigit() for c in m.group()) <= 15]
    assert [s for s in row["spans"].split(",") if s.startswith("phone")] == spans
