"""Spelling variant grouping over a frequency-vector trie.

A word's vector holds how often each letter group occurs in it. One inserted, deleted or
replaced letter changes the vector by a surplus of one at most and a deficit of one at most,
so the near words of a word lie on trie paths that spend such a budget. Words are arranged
by length and then by successive group counts. The top levels of the trie deal the words over
tasks: a word goes to its own subtree to be found, and to each subtree that its budget can
reach to search there. Below, each subtree's words are sorted by their counts, which is the
trie, and the searches go down it depth first, in blocks; the words of a leaf are verified
letter by letter.

A pair is searched from one side only: an insertion from the shorter word, a replacement from
the word that has less at the first level where the two differ (of equal vectors, from the
smaller word).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm import durable

RUN = "[A-Za-z\\u00C0-\\u00FF]"
LEAST_LENGTH = 7
LEAST_COUNT = 2
TIMES = 10  # a form is at least so many times as frequent
ONE_IN = 31  # of the runs loses a code point

SUBTREE = 30_000  # words in a dealt subtree, at most, where levels can part them
MOST_LEVELS = 12  # dealt levels below the length
LEAF = 8  # words of a trie node that are compared at once
FRONTIER = 1 << 17  # searches that go down together

#: Levels of the trie: letters from frequent to rare, then accented letters in eights.
ORDER = "eaionrtslucdhmpgbvfywkxjqz"
GROUPS = len(ORDER) + 8

_GROUP = np.zeros(256, np.int64)
for _place, _letter in enumerate(ORDER):
    _GROUP[ord(_letter)] = _place
_GROUP[0xC0:] = len(ORDER) + (np.arange(0xC0, 0x100) - 0xC0) // 8

FOUND, SEARCH_LONGER, SEARCH_LONGER_SPENT, SEARCH_EQUAL, SEARCH_EQUAL_SPENT, SEARCH_EQUAL_DONE = range(6)


def words(docs: DataFrame) -> DataFrame:
    """Distinct words and their number: (word, n), of at least 7 code points and two occurrences.

    A null text has none; a null doc_id counts as the text ''. The run of a document whose
    crc32 with the id is divisible by 31 loses one code point, as the contract says.
    """
    upper = "".join(map(chr, range(ord("A"), ord("Z") + 1)))
    run = F.explode(F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(RUN + "{%d,}" % LEAST_LENGTH), F.lit(0)))
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), run.alias("run"))
    low = runs.select("id", F.translate("run", upper, upper.lower()).alias("run"))
    h = low.select("run", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")).alias("h"))
    at = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.expr("substring(run, cast(h % length(run) as int) + 2)"))
    word = F.when(F.col("h") % ONE_IN == 0, cut).otherwise(F.col("run"))
    counted = h.select(word.alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    return counted.filter((F.length("word") >= LEAST_LENGTH) & (F.col("n") >= LEAST_COUNT))


def _letters(column) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all words, one after another, and where each begins."""
    text = column.to_pylist()
    sizes = np.fromiter(map(len, text), np.int64, len(text))
    points = np.frombuffer("".join(text).encode("utf-32-le"), np.uint32)
    return points, np.concatenate(([0], np.cumsum(sizes)))


def _vectors(points: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Counts of the letter groups, a row for each word."""
    row = np.repeat(np.arange(len(at) - 1), np.diff(at))
    flat = np.bincount(row * GROUPS + _GROUP[points], minlength=(len(at) - 1) * GROUPS)
    return flat.reshape(-1, GROUPS).astype(np.int32)


def _sizes(table: DataFrame) -> DataFrame:
    """Length and the first counts of each word, for choosing how many levels to deal."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points, at = _letters(batch["word"])
            counts = _vectors(points, at)[:, :MOST_LEVELS]
            top = np.concatenate((np.diff(at)[:, None], counts), 1).astype(np.int32)
            for_list = pa.ListArray.from_arrays(pa.array(np.arange(0, top.size + 1, MOST_LEVELS + 1, dtype=np.int32)), pa.array(top.reshape(-1)))
            yield pa.RecordBatch.from_arrays([for_list], ["top"])

    return table.select("word").mapInArrow(run, "top array<int>")


def choose_levels(table: DataFrame) -> tuple[int, int]:
    """(levels, shares): dealt levels so that a subtree has at most ``SUBTREE`` words, and
    into how many shares, by hash, a subtree is cut that no level can make small enough."""
    tops = durable.cut(_sizes(table).groupBy("top").count())
    for levels in range(2, MOST_LEVELS + 1, 2):
        prefix = F.slice("top", 1, levels + 1)
        most = tops.groupBy(prefix).agg(F.sum("count").alias("n")).agg(F.max("n")).first()[0] or 0
        if most <= SUBTREE:
            return levels, 1
    return MOST_LEVELS, -(-most // SUBTREE)


def _deal(levels: int, shares: int):
    """A row for each word in its own subtree, and one for each subtree it searches."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points, at = _letters(batch["word"])
            size, top = np.diff(at), _vectors(points, at)[:, :levels].astype(np.int64)
            every = np.arange(len(size))
            share = np.array([hash_share(w, shares) for w in batch["word"].to_pylist()], np.int64) if shares > 1 else 0 * every
            nodes, roles, take, parts = [], [], [], []

            def send(role: int, length: np.ndarray, counts: np.ndarray, who: np.ndarray, part) -> None:
                nodes.append(np.concatenate((length[:, None], counts), 1))
                roles.append(np.full(len(who), role, np.int8))
                take.append(who)
                parts.append(np.broadcast_to(part, len(who)))

            def search(role: int, length: np.ndarray, counts: np.ndarray, who: np.ndarray) -> None:
                for part in range(shares):
                    send(role, length, counts, who, part)

            send(FOUND, size, top, every, share)
            search(SEARCH_LONGER, size + 1, top, every)
            search(SEARCH_EQUAL, size, top, every)
            for more in range(levels):
                plus = top.copy()
                plus[:, more] += 1
                search(SEARCH_LONGER_SPENT, size + 1, plus, every)
                search(SEARCH_EQUAL_SPENT, size, plus, every)
                for less in range(more + 1, levels):  # the surplus comes first
                    has = np.flatnonzero(top[:, less] > 0)
                    both = plus[has]
                    both[:, less] -= 1
                    search(SEARCH_EQUAL_DONE, size[has], both, has)
            node = np.concatenate(nodes).astype(np.int32)
            key = pa.FixedSizeBinaryArray.from_buffers(pa.binary(4 * (levels + 1)), len(node), [None, pa.py_buffer(node.tobytes())])
            taken = pa.array(np.concatenate(take))
            out = [key.cast(pa.binary()), pa.array(np.concatenate(parts).astype(np.int32)), pa.array(np.concatenate(roles)), batch["word"].take(taken), batch["n"].take(taken)]
            yield from pa.Table.from_arrays(out, ["node", "share", "role", "word", "n"]).to_batches(max_chunksize=1 << 16)

    return run


def hash_share(word: str, shares: int) -> int:
    import zlib

    return zlib.crc32(word.encode()) % shares


class Trie:
    """The words of one subtree, all of one length, sorted by their counts level after level."""

    def __init__(self, counts: np.ndarray, whole: bool = True):
        # The levels that part the words best come first. A pair is searched by the order of its
        # subtree, so a share of one, which knows only its own words, keeps the given order.
        spread = [-len(np.unique(counts[:, k])) if whole else 0 for k in range(GROUPS)]
        self.levels = np.argsort(spread, kind="stable")
        counts = counts[:, self.levels]
        self.order = np.lexsort(counts.T[::-1])
        self.counts = counts[self.order]
        n = len(counts)
        node = np.zeros(n, np.int64)
        self.child_key, self.low, self.high = [], [np.zeros(1, np.int64)], [np.full(1, n)]
        for k in range(GROUPS):
            column = self.counts[:, k].astype(np.int64)
            new = np.ones(n, bool)
            new[1:] = (node[1:] != node[:-1]) | (column[1:] != column[:-1])
            first = np.flatnonzero(new)
            self.child_key.append(node[first] << 32 | column[first])  # ascending: a child's number is its place
            node = np.cumsum(new) - 1
            self.low.append(first)
            self.high.append(np.append(first[1:], n))

    def child(self, level: int, node: np.ndarray, count: np.ndarray) -> np.ndarray:
        """The child with this count of each node, -1 where there is none."""
        key = node << 32 | count.astype(np.int64)
        keys = self.child_key[level]
        at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
        return np.where((keys[at] == key) & (count >= 0), at, -1)

    def search(self, counts: np.ndarray, spent: np.ndarray, longer: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(search, word) index pairs whose vectors differ as the budget allows, in blocks.

        ``spent``: 0 nothing, 1 the surplus, 2 the deficit too. A search for a longer word has no deficit.
        """
        counts = counts[:, self.levels]
        stack = [(0, np.arange(len(counts)), np.zeros(len(counts), np.int64), spent.astype(np.int64))]
        while stack:
            level, who, node, state = stack.pop()
            if len(who) > FRONTIER:
                half = len(who) // 2
                stack += [(level, who[half:], node[half:], state[half:]), (level, who[:half], node[:half], state[:half])]
                continue
            size = self.high[level][node] - self.low[level][node]
            small = (size <= LEAF) | (level == GROUPS)
            if small.any():
                yield from self._leaves(counts, level, who[small], node[small], state[small], longer)
                who, node, state = who[~small], node[~small], state[~small]
            if not len(who) or level == GROUPS:
                continue
            own = counts[who, level]
            found = []
            for delta, may, cost in ((0, np.ones(len(who), bool), 0), (1, state == 0, 1), (-1, (state == 1) & ~longer[who], 1)):
                some = np.flatnonzero(may)
                child = self.child(level, node[some], own[some] + delta)
                some, child = some[child >= 0], child[child >= 0]
                found.append((who[some], child, state[some] + cost))
            stack.append((level + 1, *(np.concatenate(x) for x in zip(*found))))

    def _leaves(self, counts, level, who, node, state, longer) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Words of small nodes whose remaining counts fit the rest of the budget."""
        low, size = self.low[level][node], self.high[level][node] - self.low[level][node]
        begin = np.concatenate(([0], np.cumsum(size)))
        a = 0
        while a < len(who):  # bounded blocks of pairs, even where a leaf is large
            b = max(a + 1, int(np.searchsorted(begin, begin[a] + FRONTIER, "right")) - 1)
            for skip in range(0, int(size[a]) if b == a + 1 else 1, FRONTIER):
                n = np.minimum(size[a:b] - skip, FRONTIER)
                each = np.repeat(np.arange(a, b), n)
                row = low[each] + skip + np.arange(len(each)) - np.repeat(np.cumsum(n) - n, n)
                searcher, spent = who[each], state[each]
                if level < GROUPS:
                    gap = self.counts[row, level:] - counts[searcher, level:]
                    plus = np.where(gap > 0, gap, 0).sum(1) + (spent > 0)
                    minus = np.where(gap < 0, -gap, 0).sum(1) + (spent > 1)
                    first = np.where(gap.any(1), gap[np.arange(len(gap)), (gap != 0).argmax(1)], 1)
                    rising = (spent > 0) | (first > 0)
                else:
                    plus, minus, rising = (spent > 0).astype(int), (spent > 1).astype(int), True
                fits = np.where(longer[searcher], (plus == 1) & (minus == 0), (plus == minus) & (plus <= 1) & rising)
                yield searcher[fits], self.order[row[fits]]
            a = b


def near(longer: np.ndarray, found: np.ndarray) -> np.ndarray:
    """Which rows differ by exactly one inserted (``longer`` has one column less) or replaced code point."""
    if longer.shape[1] == found.shape[1]:
        return (longer != found).sum(1) == 1
    n = longer.shape[1]
    same = longer == found[:, :-1]
    head = np.where(same.all(1), n, same.argmin(1))
    same = (longer == found[:, 1:])[:, ::-1]
    tail = np.where(same.all(1), n, same.argmin(1))
    return head + tail >= n


def _search(table: pa.Table, whole: bool) -> pa.Table:
    """What one subtree finds: for each word of a near pair its number of near words here and the best of them."""
    empty = pa.table({"word": pa.array([], pa.string()), "near": pa.array([], pa.int64()), "n": pa.array([], pa.int64()), "form": pa.array([], pa.string())})
    table = table.combine_chunks()
    role = table["role"].to_numpy()
    data, ask = np.flatnonzero(role == FOUND), np.flatnonzero(role != FOUND)
    if not len(data) or not len(ask):
        return empty
    word, n = table["word"].combine_chunks(), table["n"].to_numpy()
    points, at = _letters(word)
    counts = _vectors(points, at)
    length = int(at[data[0] + 1] - at[data[0]])
    letters = points[at[data][:, None] + np.arange(length)]
    state = np.array([0, 0, 1, 0, 1, 2])[role[ask]]
    longer = role[ask] <= SEARCH_LONGER_SPENT
    step = max(1, (1 << 20) // length)
    left, right = [], []
    # What a search has spent on the dealt levels it has spent: there it goes on as one of this subtree.
    levels = len(table["node"][0].as_py()) // 4 - 1
    asked = counts[ask]
    asked[:, :levels] = counts[data[0], :levels]
    trie = Trie(counts[data], whole)
    for searcher, found in trie.search(asked, state, longer):
        for kind in (True, False):
            pick = longer[searcher] == kind
            for a in range(0, int(pick.sum()), step):
                s, f = ask[searcher[pick][a : a + step]], found[pick][a : a + step]
                own = points[at[s][:, None] + np.arange(length - kind)]
                good = near(own, letters[f])
                left.append(s[good])
                right.append(data[f[good]])
    if not left:
        return empty
    left, right = np.concatenate(left), np.concatenate(right)
    text = word.to_pylist()
    # Replacements inside a letter group leave equal vectors: both sides find each other, one counts.
    equal = (at[left + 1] - at[left] == length) & (counts[left] == counts[right]).all(1)
    keep = ~equal | np.fromiter((text[a] < text[b] for a, b in zip(left.tolist(), right.tolist())), bool, len(left))
    left, right = left[keep], right[keep]
    best: dict[str, tuple[int, int, str]] = {}
    for a, b in zip(np.concatenate((left, right)).tolist(), np.concatenate((right, left)).tolist()):
        have = best.get(text[a])
        one = (-int(n[b]), text[b])
        best[text[a]] = (1, *one) if have is None else (have[0] + 1, *min(have[1:], one))
    return pa.table(
        {
            "word": pa.array(list(best), pa.string()),
            "near": pa.array([v[0] for v in best.values()], pa.int64()),
            "n": pa.array([-v[1] for v in best.values()], pa.int64()),
            "form": pa.array([v[2] for v in best.values()], pa.string()),
        }
    )


def near_words(table: DataFrame) -> DataFrame:
    """(word, n_near, best_n, best) for each word of ``table`` (word, n) that has a near word there."""
    levels, shares = choose_levels(table)
    dealt = table.mapInArrow(_deal(levels, shares), "node binary, share int, role byte, word string, n long")
    parts = dealt.groupBy("node", "share").applyInArrow(
        lambda part: _search(part, shares == 1), "word string, near long, n long, form string"
    )
    best = F.min(F.struct((-F.col("n")).alias("less"), "form"))
    return parts.groupBy("word").agg(F.sum("near").alias("n_near"), (-best["less"]).alias("best_n"), best["form"].alias("best"))


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) by doubling: a word's pointer jumps to its pointer's pointer until none moves."""
    now = durable.cut(forms.select("word", F.col("form").alias("root")))
    while True:
        on = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = durable.cut(now.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moves")))
        now = moved.select("word", "root")
        if moved.filter("moves").isEmpty():
            return now


def variants(docs: DataFrame) -> DataFrame:
    """One row for each word of :func:`words`: word, form, root, n, n_near, form_n.

    A form is the near word of largest n (ties: the smallest), if it is at least ten times as
    frequent. Forms rise in n, so following them ends. Repeated documents count again; an
    empty table or one without such words gives no row; extra columns are ignored. Words of
    any length are compared whole.
    """
    table = durable.cut(words(docs))
    found = table.join(near_words(table), "word", "left")
    has = F.col("best_n") >= TIMES * F.col("n")
    rows = durable.cut(
        found.select(
            "word",
            F.when(has, F.col("best")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(has, F.col("best_n")).alias("form_n"),
        )
    )
    roots = _roots(rows.filter("form is not null"))
    return rows.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
