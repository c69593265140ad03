"""Substring and suffix dedup, rules and SimHash against brute force."""

import collections
import hashlib
import random
import re
from itertools import combinations

import numpy as np
import pytest
import xxhash

from tarmac.llm import blocks, graph, rules, simhash, substring, suffix, textnum

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def corpus(seed, n=60):
    """Random texts with shared passages, copies, near copies and periodic ones."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abé") for _ in range(r.randint(1, 4)))
    passage = " ".join(word() for _ in range(60))
    texts = []
    for i in range(n):
        own = [word() for _ in range(r.randint(0, 120))]
        if i % 4 == 0:
            at = r.randint(0, len(own))
            own[at:at] = passage.split()[r.randint(0, 15) :]
        if i % 7 == 0:
            own += ["ab"] * r.randint(30, 80)
        text = r.choice([" ", "\n", "  "]).join(own)
        if i % 5 == 0 and texts:
            text = texts[r.randrange(len(texts))]
            if i % 2:
                cut = r.randint(0, len(text))
                text = text[:cut] + "x" + text[cut:]
        texts.append(text)
    return texts


def test_cover_is_a_difference_cover():
    assert {(a - b) % substring.PERIOD for a in substring.COVER for b in substring.COVER} == set(range(substring.PERIOD))


def brute_substring(rows):
    found = collections.Counter()
    split = [WORD.findall(t or "") for _, t in rows]
    for w in split:
        found.update(tuple(w[k : k + 35]) for k in range(len(w) - 34))
    for (doc_id, _), w in zip(rows, split):
        gone = {k + j for k in range(len(w) - 34) if found[tuple(w[k : k + 35])] > 1 for j in range(35)}
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        yield doc_id, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()


@pytest.mark.parametrize("seed", [1, 2])
def test_substring_dedup(documents, odd, clashing, seed):
    rows = [*odd, *[(100 + i, t) for i, t in enumerate(corpus(seed))]]
    got = substring.remove_repeats(documents(rows, clashing)).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, brute_substring(rows)))


def brute_suffix(rows):
    first = {}
    key = lambda i: (i is None, i or 0)
    data = [(i, (t or "").encode()) for i, t in rows]
    for i, b in data:
        for k in range(len(b) - 49):
            s = b[k : k + 50]
            first[s] = min(first.get(s, key(i)), key(i))
    for i, b in data:
        gone = bytearray(len(b))
        for k in range(len(b) - 49):
            if first[b[k : k + 50]] < key(i):
                gone[k : k + 50] = b"\1" * 50
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for k in range(len(b)) if gone[k] and (k == 0 or not gone[k - 1]))
        yield i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()


@pytest.mark.parametrize("seed, crowd", [(1, 48), (2, 2)])
def test_suffix_dedup(documents, odd, clashing, monkeypatch, seed, crowd):
    monkeypatch.setattr(suffix, "CROWD", crowd)
    rows = [*odd, (None, "word " * 30), *[(100 + i % 50, t) for i, t in enumerate(corpus(seed))]]
    got = suffix.remove_later_copies(documents(rows, clashing)).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, brute_suffix(rows)))


@pytest.mark.parametrize("seed", range(12))
def test_suffix_sort_is_byte_order(seed):
    r = random.Random(seed)
    text = bytes(r.choice(b"abcdefgh"[: r.choice([1, 2, 8])]) for _ in range(120)) * r.choice([1, 3])
    starts = [r.randrange(len(text)) for _ in range(r.choice([1, 2, 60]))]
    ends = [r.randint(a, len(text)) for a in starts]
    order, classes = suffix.sort_pieces(np.frombuffer(text, np.uint8), np.array(starts), np.array(ends))
    pieces = [text[a:b] for a, b in zip(starts, ends)]
    assert [pieces[k] for k in order] == sorted(pieces)
    assert [sorted(set(pieces))[c] for c in classes] == pieces


def test_hash_collisions_are_verified(monkeypatch):
    from tarmac.llm import textnum

    monkeypatch.setattr(textnum, "_BYTES", np.ones(256, np.uint64))  # every substring of one length collides
    data = np.frombuffer(b"abcdefghXabcdefghYabcdefghX", np.uint8)
    _, classes = suffix.sort_pieces(data, np.array([0, 9, 18]), np.array([9, 18, 27]))
    assert classes[1] not in (classes[0], classes[2])


def test_equal_pieces_are_not_compared_by_extension(monkeypatch):
    compared = []
    raw = textnum.PrefixHash.raw
    monkeypatch.setattr(textnum.PrefixHash, "raw", lambda self, start, end: (compared.append(len(start)), raw(self, start, end))[1])
    piece = b"a passage that many documents have, word for word, and more"
    text = b"".join(piece + bytes([97 + k % 3]) for k in range(3000))
    starts = np.arange(3000) * (len(piece) + 1)
    order, classes = suffix.sort_pieces(np.frombuffer(text, np.uint8), starts, starts + len(piece) + 1)
    assert classes.tolist() == [k % 3 for k in range(3000)]
    assert order.tolist() == sorted(range(3000), key=lambda k: k % 3)
    assert sum(compared) < 1000


def _block(texts, number=0):
    import pyarrow as pa

    return blocks.Block(pa.table({"block": pa.array([number] * len(texts), pa.int32()), "doc_id": range(len(texts)), "text": texts}))


def test_anchors_do_not_depend_on_windows(monkeypatch):
    r = random.Random(5)
    texts = ["".join(r.choice("ab cd") for _ in range(r.choice([0, 49, 50, 51, 300, 2000]))) for _ in range(40)] + ["x" * 400]
    block, found = _block(texts), []
    copies = np.arange(len(texts)) % 7 == 3
    for window in (1 << 15, 64, 1):
        monkeypatch.setattr(suffix, "WINDOW", window, raising=False)
        a = suffix._Anchored(block, copies)
        found.append([x.tolist() for x in (a.place, a.key, a.first, a.last, a.ids)])
    assert found[0] == found[1] == found[2]
    starts = [k for a, b in zip(found[0][2], found[0][3]) for k in range(a, b + 1)]
    at = block.offsets.tolist()
    assert starts == [k for i in range(len(texts)) if not copies[i] for k in range(at[i], at[i + 1] - 49)]


def test_passage_of_every_block_travels_in_whole_pieces():
    """An anchor is crowded by its different pieces, not by the number of blocks."""
    parts = blocks.Parts(2, 64)
    share = -(-suffix.CROWD // 64)
    key = np.array([1 << 62], np.uint64)
    flags = lambda yes: np.array([yes])

    def hot(dense):
        tables = [blocks.send_keys(parts, b, key, flags(False), flags(d)) for b, d in enumerate(dense)]
        replies = blocks.reply_shared(suffix.CROWD)(list(range(64)), [t["data"][0].as_py() for t in tables])
        shared, crowded = zip(*(blocks.read_shared(parts, key, {1: r}) for r in replies))
        assert np.all(shared)
        return {bool(c[0]) for c in crowded}

    assert hot([False] * 64) == {False}
    assert hot([False] * 63 + [True]) == {True}
    passage = "the very same long passage stands in all of these rows, word for word"
    anchored = suffix._Anchored(block := _block([passage] * 9), np.zeros(9, bool))
    keys, back, _ = anchored.keys()
    assert not anchored.dense(block.data, back, len(keys), 2).any()
    anchored = suffix._Anchored(block := _block([f"{passage}{k}" for k in range(9)]), np.zeros(9, bool))
    keys, back, _ = anchored.keys()
    assert anchored.dense(block.data, back, len(keys), 5).any()  # a digit may make an anchor of its own
    assert not anchored.dense(block.data, back, len(keys), 10).any()
    assert share > 9


@pytest.mark.parametrize("crowd", [2, 1 << 30])
def test_block_replies_line_up(crowd):
    parts = blocks.Parts(2)
    rng = np.random.default_rng(3)
    sent = {b: np.unique(rng.integers(0, 40, 25).astype(np.uint64) << np.uint64(58)) for b in range(3)}
    often = {b: rng.random(len(k)) < 0.2 for b, k in sent.items()}
    inbox = collections.defaultdict(list)
    for b, keys in sent.items():
        table = blocks.send_keys(parts, b, keys, often[b])
        for part, block, data in zip(*(table[c].to_pylist() for c in ("part", "block", "data"))):
            inbox[part].append((block, data))
    back = {b: {} for b in sent}
    for part, messages in inbox.items():
        for (b, _), reply in zip(messages, blocks.reply_shared(crowd)([m[0] for m in messages], [m[1] for m in messages])):
            back[b][part] = reply
    count = collections.Counter(int(k) for keys in sent.values() for k in keys)
    loud = {int(k) for b, keys in sent.items() for k, o in zip(keys, often[b]) if o}
    for b, keys in sent.items():
        shared, hot = blocks.read_shared(parts, keys, back[b])
        assert [bool(s) for s in shared] == [count[int(k)] > 1 or int(k) in loud for k in keys]
        assert [bool(h) for h in hot] == [count[int(k)] >= crowd for k in keys]


def brute_counts(text):
    text = text or ""
    w = WORD.findall(text)
    threes = collections.Counter(tuple(w[k : k + 3]) for k in range(len(w) - 2))
    covered = {k + j for k in range(len(w) - 2) if threes[tuple(w[k : k + 3])] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def test_rules_counts_and_verdict(spark, documents, odd, clashing):
    good = ["A plain line of prose that ends as a sentence should.\nAnother one follows it with other words, and ends."] * 1
    texts = [good[0].replace("prose", f"prose{i}") * 4 for i in range(30)]
    junk = ["buy### now*** $$$ | home | about%%% | " + " ".join(f"w{i}{k}&&&" for k in range(60)) for i in range(30)]
    rows = [*odd, *[(1000 + i, t) for i, t in enumerate(texts + junk)], (2000, "a b c\n\na b c\nd # a\n" * 9)]
    labels = spark.createDataFrame([(1000 + i, int(i < 30), 0) for i in range(60)], "doc_id long, quality int, toxic int")
    got = rules.line_rules(documents(rows, clashing), labels).collect()
    assert len(got) == len(rows)
    expected = collections.Counter((i, *brute_counts(t)) for i, t in rows)
    assert collections.Counter((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) for r in got) == expected
    for r in got:
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])
        assert not (r["kept"] and r["base_failed"])
    assert not any(r["kept"] for r in got if r["doc_id"] and 1030 <= r["doc_id"] < 1060)


def test_viterbi_equals_trying_every_labelling():
    rng = np.random.default_rng(5)
    for n in range(1, 7):
        field = rules.Field(None, rng.normal(size=(2, 2)), rng.normal(size=2))
        scores = rng.normal(size=(n, 2))

        def total(y):
            return field.begin[y[0]] + sum(scores[k, v] for k, v in enumerate(y)) + sum(field.move[a, b] for a, b in zip(y, y[1:]))

        best = max(np.ndindex(*[2] * n), key=total)
        assert tuple(rules.viterbi(scores, field)) == best


def test_rules_on_an_empty_table(spark, documents):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert rules.line_rules(documents([]), labels).count() == 0


def test_position_sets_meet_every_five_positions():
    for five in combinations(range(8), 5):
        assert any(set(p) <= set(five) for p in simhash.POSITIONS)


def brute_fingerprint(text):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(w[k : k + 3]) for k in range(max(len(w) - 2, 1))] if w else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components_of(keys, linked):
    root = {k: k for k in keys}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in linked:
        root[find(a)] = find(b)
    return {k: find(k) for k in keys}


def test_simhash_components(documents, odd, clashing):
    rows = [*odd, *[(100 + i, t) for i, t in enumerate(corpus(3))], *[(300 + i, "the same text here " * 9 + f"w{i % 6}") for i in range(40)]]
    got = simhash.near_duplicates(documents(rows, clashing)).collect()
    fps = [brute_fingerprint(t) for _, t in rows]
    near = [(a, b) for a, b in combinations(sorted(set(fps)), 2) if (a ^ b).bit_count() <= 3]
    root = components_of(set(fps), near)
    low = {}
    for (i, _), f in zip(rows, fps):
        if i is not None:
            low[root[f]] = min(low.get(root[f], i), i)
    expected = [(i, format(f, "016x"), low.get(root[f])) for (i, _), f in zip(rows, fps)]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, expected))


@pytest.mark.parametrize("long_list", [4096, 8])
def test_simhash_links_in_dense_lists(spark, monkeypatch, long_list):
    monkeypatch.setattr(simhash, "LONG_LIST", long_list)
    rng = random.Random(8)
    centre = rng.getrandbits(64)
    values = {centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 6))) for _ in range(80)}
    values |= {rng.getrandbits(64) for _ in range(40)}
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    nodes = spark.createDataFrame([(v,) for v in signed], "_fp long")
    found = graph.components(simhash.links(nodes))
    got = {r["node"]: r["root"] for r in found.collect()}
    near = [(a, b) for a, b in combinations(signed, 2) if ((a ^ b) & (1 << 64) - 1).bit_count() <= 3]
    root = components_of(signed, near)
    lowest = {}
    for v in signed:
        lowest[root[v]] = min(lowest.get(root[v], v), v)
    assert {v: got.get(v, v) for v in signed} == {v: lowest[root[v]] for v in signed}


def test_keep_one_of_each_group(documents, odd, clashing):
    rows = [*odd, (20, "alpha beta gamma delta"), (19, "alpha beta gamma delta"), (None, "alpha beta gamma delta")]
    docs = documents(rows, clashing)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    component = {(r["doc_id"], r["fingerprint"]): r["component_id"] for r in simhash.near_duplicates(docs).collect()}
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(component.values()))
    assert 19 in {r["doc_id"] for r in kept.collect()}


@pytest.mark.parametrize("name", ["op6_substring", "op10_suffix"])
def test_sql_statements_agree(spark, name):
    import duckdb

    from tarmac.llm import queries

    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf}/documents.parquet')")
    want = con.sql(queries.STATEMENTS[name])
    got = queries.QUERIES[name](spark, sf).select(*want.columns)
    assert sorted(map(tuple, got.collect())) == sorted(want.fetchall())


def test_empty_tables(documents):
    empty = documents([])
    assert substring.remove_repeats(empty).count() == 0
    assert suffix.remove_later_copies(empty).count() == 0
    assert simhash.near_duplicates(empty).count() == 0
    assert simhash.keep_one(empty).count() == 0


def thue_morse(n):
    """A word over a and b, and the word with both exchanged: equal under any odd base modulo 2**64 from 1,024 letters on."""
    bits = [bin(k).count("1") % 2 for k in range(n)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


def test_digests_tell_thue_morse_words_apart():
    for n in (8, 64, 65, 1024, 2048):
        a, b = thue_morse(n)
        data = np.frombuffer((a + b).encode(), np.uint8)
        start, end = np.array([0, n]), np.array([n, 2 * n])
        one, other = textnum.digests(data, start, end)
        assert one != other and one != textnum.digests(data, start, end, seed=1)[0]
        flags = np.concatenate([textnum.mix(np.array([1, 2], np.uint64))[[int(c == "b") for c in w]] for w in (a, b)])
        windows = textnum.window_digests(flags, n)
        assert windows[0] != windows[n] and len(windows) == n + 1
    assert len(textnum.window_digests(np.zeros(3, np.uint64), 4)) == 0


def test_window_digests_agree_where_windows_do():
    rng = np.random.default_rng(0)
    values = textnum.mix(rng.integers(0, 3, 400).astype(np.uint64))
    for size in (1, 2, 3, 5, 8, 15, 35):
        found = textnum.window_digests(values, size)
        seen = {}
        for k, digest in enumerate(found.tolist()):
            assert seen.setdefault(digest, tuple(values[k : k + size])) == tuple(values[k : k + size])
        assert len(seen) == len({tuple(values[k : k + size]) for k in range(len(found))})


def test_substring_dedup_of_thue_morse_words(documents):
    a, b = thue_morse(1024)
    shared = [f"w{k}" for k in range(17)]
    rows = [(1, " ".join([*shared, a, *shared])), (2, " ".join([*shared, b, *shared])), (3, " ".join([*shared, a, *shared]))]
    got = substring.remove_repeats(documents(rows)).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, brute_substring(rows)))
    assert {r["doc_id"]: r["n_removed"] for r in got} == {1: 35, 2: 0, 3: 35}


def test_rules_count_thue_morse_lines(spark, documents):
    a, b = thue_morse(2048)
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    (row,) = rules.line_rules(documents([(1, f"{a}\n{b}\n{a} x y\n{b} x y")]), labels).collect()
    assert (row["n_dup_lines"], row["n_repeat_words"]) == (0, 0)


def test_mixed_texts_are_split_where_their_lines_change(spark, documents):
    """Good texts hold a menu, bad ones a paragraph; only texts are labelled, lines are judged."""
    r = random.Random(3)
    prose = lambda: " ".join(r.choice(["river", "stone", "walks", "slowly", "the", "green"]) for _ in range(r.randint(9, 20))) + "."
    junk = lambda: " ".join(r.choice(["$$$", "BUY", "###", "NOW", "4711", "|||"]) for _ in range(r.randint(2, 6)))
    rows, marks, truth = [], [], {}
    for i in range(400):
        share = r.choice([0.0, 0.2, 0.35, 0.65, 0.8, 1.0])
        n = r.randint(10, 20)
        content = round(share * n)
        lines = [prose() for _ in range(content)] + [junk() for _ in range(n - content)]
        if r.random() < 0.5:
            lines.reverse()
        rows.append((i, "\n".join(lines)))
        size = lambda text: sum(map(len, text.split()))
        truth[i] = sum(size(x) for x in lines if x.endswith(".")) / sum(map(size, lines))
        if i < 300:
            marks.append((i, int(share > 0.5), 0))
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    field = rules.fit(documents(rows), labels)
    got = {g["doc_id"]: g["content_share"] for g in rules.judge(documents(rows), field).collect()}
    held = [i for i in range(300, 400)]
    assert np.mean([abs(got[i] - truth[i]) for i in held]) < 0.05
    mixed = [i for i in held if 0.1 < truth[i] < 0.9]
    assert len(mixed) > 20 and np.mean([abs(got[i] - truth[i]) < 0.1 for i in mixed]) > 0.9
