"""SentencePiece ids against the library; spelling variants and the prefix trie against brute force."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from tarmac.llm import prefix_trie, sentencepiece_bpe, spelling

public_tokenizers = pytest.importorskip("public_tokenizers")
sentencepiece = pytest.importorskip("sentencepiece")
MODEL = public_tokenizers.path("piece_bpe_32k.model")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


# --- pieces -----------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def encoder():
    return sentencepiece_bpe.Encoder(sentencepiece_bpe.Vocabulary.read(MODEL))


def texts(seed, encoder):
    r = random.Random(seed)
    alphabet = "abcdeéßthng AB019 \t\n.,;-_<>/'\"漢字日кир한😀👍🏽́▁ 　​\x00\r▁  "
    pieces = [p.replace("▁", " ") for p in encoder.ids]
    out = ["", " ", "  a  b ", "<s>x</s>", "<0x41>", "▁", "﻿x", "é", *[c * n for c in "a =-\n" for n in range(1, 40, 3)]]
    out += ["".join(r.choice(alphabet) for _ in range(r.randint(0, 80))) for _ in range(1500)]
    return out + ["".join(r.choice(pieces) for _ in range(r.randint(1, 30))) for _ in range(1500)]


@pytest.mark.parametrize("seed", [1, 2])
def test_ids_and_text_equal_the_library(encoder, library, seed):
    for text in texts(seed, encoder):
        ids = encoder.encode(text)
        assert ids == library.encode(text), text
        assert encoder.decode(ids) == library.decode(ids) == text.replace("▁", " "), text


def test_whole_text_without_parts(encoder, library):
    """A vocabulary whose pieces hold inner spaces is encoded whole; the prefix table alone must do."""
    for text in texts(3, encoder)[:600]:
        whole = "▁" + text.replace(" ", "▁") if text else ""
        assert (encoder.encode_part(whole) if whole else []) == library.encode(text)


def test_any_ids_decode_as_in_the_library(encoder, library):
    r = random.Random(5)
    lists = [[r.choice([r.randrange(259), r.randrange(32000)]) for _ in range(r.randint(0, 12))] for _ in range(3000)]
    lists += [[], [2], [1, 2], [0], [14, 121, 211, 2, 170], [259], [259, 259]]
    want = [library.decode(ids) for ids in lists]
    assert [encoder.decode(ids) for ids in lists] == want
    offsets = np.concatenate(([0], np.cumsum([len(x) for x in lists])))
    flat = np.array([i for x in lists for i in x])
    assert sentencepiece_bpe.Decoder(encoder).decode(flat, offsets) == want


def test_a_long_text_without_spaces_is_linear(encoder, library):
    text = "abcxyz漢" * 30_000
    assert encoder.encode(text) == library.encode(text)


def test_pieces_of_documents(documents, odd, clashing, library):
    rows = [*odd, (20, "x" * 200_000), (21, "Größe 漢字 \x00 end ")]
    docs = documents(rows, [*clashing, "ids", "decoded"])
    got = sentencepiece_bpe.digests(docs, MODEL).collect()
    want = []
    for doc_id, text in rows:
        ids = library.encode(text or "", add_eos=True)
        digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
        want.append((doc_id, len(ids), digest(" ".join(map(str, ids))), digest(library.decode(ids))))
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    encoded = sentencepiece_bpe.encode(docs, MODEL, end=False)
    assert set(encoded.columns) == set(docs.columns) and encoded.count() == len(rows)
    assert sentencepiece_bpe.digests(documents([]), MODEL).count() == 0
    none = encoded.selectExpr("doc_id", "cast(null as array<int>) AS ids").limit(3)
    assert {r["decoded"] for r in sentencepiece_bpe.decode(none, MODEL).collect()} == {""}


# --- spelling ---------------------------------------------------------------

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def brute_variants(rows):
    counts = collections.Counter()
    for doc_id, text in rows:
        for run in RUN.findall(text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1 :]
            if len(run) >= 7:
                counts[run] += 1
    n = {w: c for w, c in counts.items() if c >= 2}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        short, long = sorted((a, b), key=len)
        return len(long) == len(short) + 1 and any(long[:k] + long[k + 1 :] == short for k in range(len(long)))

    close = {w: [v for v in n if abs(len(v) - len(w)) <= 1 and near(w, v)] for w in n}
    form = {}
    for w, c in n.items():
        best = min(close[w], key=lambda v: (-n[v], v), default=None)
        if best is not None and n[best] >= 10 * c:
            form[w] = best
    for w in n:
        root = w
        while root in form:
            root = form[root]
        yield w, form.get(w), root, n[w], len(close[w]), n[form[w]] if w in form else None


def variant_rows(seed):
    r = random.Random(seed)
    stems = ["".join(r.choice("abeéÀÿß") for _ in range(r.randint(7, 10))) for _ in range(6)] + ["Wasserfall", "wasserfälle"]
    rows = []
    for i in range(260):
        words = []
        for _ in range(r.randint(0, 12)):
            w = r.choice(stems[: r.choice([1, 2, 8])])
            if r.random() < 0.25:
                k = r.randrange(len(w))
                w = r.choice([w[:k] + w[k + 1 :], w[:k] + r.choice("abéÿ") + w[k + 1 :], w[:k] + r.choice("abéÿ") + w[k:]])
            words.append(w.upper() if r.random() < 0.1 and w.isascii() else w)
        rows.append((i, r.choice([" ", "-", "\n", "9"]).join(words)))
    chain = ["strasse"] * 400 + ["strassen"] * 30 + ["strassenx"] * 2  # forms of forms
    rows += [(1000 + k, w) for k, w in enumerate(chain)]
    return rows + [(900, "zz" * 4000 + " " + "zz" * 4000), (901, "zz" * 4000), (902, "zz" * 4000 + "z")] + [(903, "zz" * 4000 + "z")] * 3


@pytest.mark.parametrize("seed, subtree", [(1, None), (2, 4)])
def test_variants(documents, odd, clashing, monkeypatch, seed, subtree):
    if subtree:  # so few words in a subtree that deep levels are dealt and even whole vectors are shared out
        monkeypatch.setattr(spelling, "SUBTREE", subtree)
        monkeypatch.setattr(spelling, "LEAF", 1)
        monkeypatch.setattr(spelling, "FRONTIER", 64)
    rows = [*odd, *variant_rows(seed)]
    got = spelling.variants(documents(rows, [*clashing, "word", "n", "form", "id", "run"])).collect()
    want = list(brute_variants(rows))
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert sum(w[1] is not None for w in want) > 10 and any(w[1] != w[2] for w in want if w[1])


def test_levels_are_dealt_deeper_and_then_shared_out(documents, monkeypatch):
    monkeypatch.setattr(spelling, "SUBTREE", 4)
    table = spelling.words(documents(variant_rows(2)))
    levels, shares = spelling.choose_levels(table)
    assert levels == spelling.MOST_LEVELS and shares > 1


def test_no_words_no_rows(documents):
    assert spelling.variants(documents([])).count() == 0
    assert spelling.variants(documents([(1, "short words only"), (2, None)])).count() == 0


# --- prefix trie --------------------------------------------------------------


def brute_trie(rows):
    own = collections.defaultdict(list)
    digest = lambda role, text: hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            own[conv].append(((turn is not None, turn or 0, digest(role, text)), (role, text)))
    own = {c: [t for _, t in sorted(turns)] for c, turns in own.items()}
    built = {}
    for c, turns in own.items():
        base, h = c - c % 20, zlib.crc32(str(c).encode()) % 4
        built[c] = own.get(base, [])[:h] + turns[h:]
    members = collections.defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = collections.defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        words = len(WORD.findall(node[-1][1])) if node else 0
        leaves[node] = sum(leaves[k] for k in children[node]) or 1
        saved[node] = (len(members[node]) - 1) * words + sum(saved[k] for k in children[node])
    for node, convs in members.items():
        ends = ",".join(map(str, sorted(c for c in convs if len(built[c]) == len(node))))
        yield (
            min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), len(children[node]),
            leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest(),
        )


def conversations(seed):
    r = random.Random(seed)
    rows = []
    shared = [("user", f"hello there {k}") for k in range(3)]
    for c in r.sample(range(130), 90) + [2000, 2001, 2005, 2019, 4444]:
        turns = [(r.choice(["user", None, ""]), r.choice(["a b", "a  b c", "", None, "x" * 50])) for _ in range(r.randint(1, 6))]
        if c % 3 == 0:
            turns = shared[: r.randint(1, 3)] + turns
        if c % 7 == 0:
            turns = shared * 60  # long and copied
        rows += [(c, r.choice([k, k, None]) if c % 5 == 0 else k, *t) for k, t in enumerate(turns)]
    rows += [rows[0], rows[0], (None, 0, "user", "of nobody"), (7777, 0, "user", "z " * 20_000)]
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed, cells", [(1, None), (2, 0)])
def test_trie(spark, monkeypatch, seed, cells):
    if cells is not None:  # a sketch so small that hardly a singleton is proved: the result is the same
        monkeypatch.setattr(prefix_trie, "SLICE_BITS", 3)
        monkeypatch.setattr(prefix_trie, "MOST_CELLS", 8)
    rows = conversations(seed)
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    clash = table.selectExpr("*", *[f"'x' AS `{c}`" for c in ("words", "family", "depth", "hi", "lo", "last", "member")])
    got = prefix_trie.trie(clash).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, brute_trie(rows)))


def test_a_conversation_over_many_tasks(spark, monkeypatch):
    rows = [(40, k % 9, "user", f"t{k % 5}") for k in range(300)]  # a base
    rows += [(c, k, "user", f"t{k % 5}") for c in (41, 45, 59) for k in range(200)] + [(60, 0, "a", "b")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "37")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        turns = prefix_trie._laid_out(table)
        most = turns.groupBy("conv_id").agg({"*": "count"}).count()
        tasks = turns.selectExpr("conv_id", "spark_partition_id() AS p").distinct().groupBy("conv_id").count().collect()
        assert most == 5 and max(r["count"] for r in tasks) > 5
        got = prefix_trie.trie(table).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, brute_trie(rows)))


def test_no_conversation_no_node(spark):
    schema = "conv_id long, turn long, role string, text string"
    assert prefix_trie.trie(spark.createDataFrame([], schema)).count() == 0
    assert prefix_trie.trie(spark.createDataFrame([(None, 1, "a", "b")], schema)).count() == 0


def test_members_of_a_large_node_are_packed_and_hashed_in_order(spark):
    rows = [(5, 2, m) for m in range(10_000)] + [(7, 0, -3), (7, 0, 9)]
    found = prefix_trie._ends(spark.createDataFrame(rows, "conv_id long, depth long, member long").repartition(7))
    digest = lambda ids: hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    assert {tuple(r) for r in found.collect()} == {(5, 2, digest(range(10_000))), (7, 0, digest([-3, 9]))}
