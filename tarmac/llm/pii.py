"""Personal data: base patterns, and identifiers found by bootstrapped contexts. DataFrame functions only.

Base spans come from fixed patterns (email, ip, card, phone) with their checks. Positions are
exact because a text is the alternation of what lies between matches (``split``) and the
matches themselves (``regexp_extract_all``), both found by one regular expression.

The base spans are the seeds. The nearest word and the nearest two words on either side of them
are lexical patterns; symbols and numbers between are skipped. Every token with a
digit, and every handle or dotted name, is a possible instance. Patterns and instances form a bipartite graph over the corpus.
Scores go back and forth a few times: a pattern is as good as the mean score of its distinct
instances, provided that enough of them are seeds or were accepted in a round before; an instance is as good as its patterns
together (noisy or). Instances that end above ``ACCEPT`` are identifiers the patterns
discovered, and every occurrence of them becomes a span of kind ``id``.

Both directions are aggregations with partial sums and joins with one row per key on one
side, so a very common word or a token in a third of all texts does not gather in one task.
Texts are extracted once; copies of a text go through the graph as one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.llm import durable

KINDS = ["email", "ip", "card", "phone"]
ROUNDS = 3  # of scores going back and forth
LEAST_SEEDS = 5  # distinct seeds or discovered identifiers next to a pattern before it scores
TRUST = 0.8  # score from which a pattern is a high-confidence one
ACCEPT = 0.9  # score from which an instance is an identifier
RUN = 512  # matches that are located together
LEAST_LENGTH = 6  # characters of an identifier
CONTEXT = 40  # characters beside a token in which its neighbour word is looked for

# The base patterns, written so that a long run of characters is walked once: a run may be
# entered only at its start or where the last match ended, and is not given back.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_GUARDS = {"email": "@", "phone": "+"}
_BREAK = r"\x20\x09-\x0D=|<>()\[\]{},;\"'`"  # what a token ends at
# A digit, or a handle or name: "@" before a letter, "_" or "." between letters.
_MARK = r"[0-9]|@\p{L}|\p{L}[_.]\p{L}"
_TOKEN = rf"(?<![^{_BREAK}])(?=[^{_BREAK}]*?(?:{_MARK}))[^{_BREAK}]++"

_SPANS = "array<struct<start:int,stop:int,value:string,left:string,right:string>>"


def _empty() -> Column:
    return F.expr(f"cast(array() as {_SPANS})")


def _in_runs(items: Column) -> Column:
    """An array cut into runs of ``RUN``, so that lists that grow one by one stay short."""

    def cut(xs: Column) -> Column:
        last = F.floor((F.size(xs) - 1) / RUN).cast("int")
        starts = F.when(F.size(xs) > 0, F.sequence(F.lit(0), last)).otherwise(F.expr("cast(array() as array<int>)"))
        return F.transform(starts, lambda k: F.slice(xs, k * RUN + 1, F.lit(RUN)))

    return F.transform(F.array(items), cut)[0]


def _matches(text: Column, pattern: str) -> Column:
    """(start, stop, value, text left and right) of the leftmost non-overlapping matches, in code points.

    The texts beside a match leave out the matches next to it, and look behind one of them.
    """
    both = F.struct(
        F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("value")
    )

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["gap"])
        stop = start + F.length(x["value"])
        one = F.struct(
            start.alias("start"),
            stop.alias("stop"),
            x["value"].alias("value"),
            F.right(F.concat_ws(" ", x["before"], x["gap"]), F.lit(CONTEXT)).alias("left"),
            F.left(F.concat_ws(" ", x["after"], x["beyond"]), F.lit(CONTEXT)).alias("right"),
        )
        return F.when(x["value"].isNull(), acc).otherwise(
            F.struct(stop.alias("at"), F.concat(acc["out"], F.array(one)).alias("out"))
        )

    def located(b: Column) -> Column:
        gap, n = b["gap"], F.size(b["gap"])
        zipped = F.arrays_zip(
            gap.alias("gap"),
            b["value"].alias("value"),
            F.concat(F.array(F.lit("")), gap).alias("before"),
            F.slice(gap, F.lit(2), n).alias("after"),
            F.slice(gap, F.lit(3), n).alias("beyond"),
        )
        def run(acc: Column, part: Column) -> Column:
            begin = F.struct(acc["at"].alias("at"), _empty().alias("out"))
            done = F.aggregate(part, begin, step)
            joined = lambda d: F.struct(d["at"].alias("at"), F.concat(acc["out"], F.array(d["out"])).alias("out"))
            return F.transform(F.array(done), joined)[0]

        none = F.slice(F.array(_empty()), F.lit(1), F.lit(0))
        begin = F.struct(F.lit(0).alias("at"), none.alias("out"))
        return F.aggregate(_in_runs(zipped), begin, run, lambda acc: F.flatten(acc["out"]))

    return F.transform(F.array(both), located)[0]  # split once


def _luhn(digits: Column) -> Column:
    """Whether a text of at least one digit passes the Luhn check."""
    n = F.length(digits)

    def step(total: Column, i: Column) -> Column:
        digit = F.substr(digits, i, F.lit(1)).cast("int")
        twice = digit * 2
        return total + F.when((n - i) % 2 == 1, F.when(twice > 9, twice - 9).otherwise(twice)).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), step) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        # At most three digits after leading zeros, and at most 255.
        part = lambda p: F.regexp_replace(p, "^0+(?=[0-9])", "")
        return F.forall(
            F.split(value, r"\."),
            lambda p: F.when(F.length(part(p)) <= 3, part(p).cast("int") <= 255).otherwise(False),
        )
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "card":
        return F.when(F.length(digits).between(13, 19), _luhn(digits)).otherwise(False)
    return F.length(digits).between(9, 15)


def base_spans(kind: str, text: Column) -> Column:
    """The kind's spans in a text that is not null."""
    hint = text.contains(_GUARDS[kind]) if kind in _GUARDS else text.rlike("[0-9]")
    return F.when(hint, F.filter(_matches(text, PATTERNS[kind]), lambda s: _valid(kind, s["value"]))).otherwise(_empty())


def _patterns(span: Column) -> Column:
    """(side, nearest word, pattern): the nearest word and the nearest two on either side of a span, lower-cased."""

    def words(side: str) -> Column:
        plain = F.regexp_replace(span[side], r"[^\x20\x09-\x0D]*[0-9@][^\x20\x09-\x0D]*", " ")
        return F.regexp_extract_all(F.lower(plain), F.lit(r"\p{L}+"), F.lit(0))

    def named(side: str, near: Column, far: Column) -> Column:
        root = F.concat(F.lit(f"{side} "), near)
        return F.array(
            F.struct(root.alias("root"), root.alias("pattern")),
            F.struct(root.alias("root"), F.concat(root, F.lit(" "), far).alias("pattern")),
        )

    found = F.concat(
        F.transform(F.array(words("left")), lambda w: named("left", F.try_element_at(w, F.lit(-1)), F.try_element_at(w, F.lit(-2))))[0],
        F.transform(F.array(words("right")), lambda w: named("right", F.try_element_at(w, F.lit(1)), F.try_element_at(w, F.lit(2))))[0],
    )
    return F.filter(found, lambda x: x["pattern"].isNotNull())


def _candidates(text: Column, base: Column) -> Column:
    """Base spans, as seeds, and tokens that meet none of them, without edge punctuation; long enough ones."""

    def placed(s: Column, start: Column, stop: Column, value: Column, seed: bool) -> Column:
        return F.struct(
            start.alias("start"), stop.alias("stop"), value.alias("value"), _patterns(s).alias("patterns"), F.lit(seed).alias("seed")
        )

    def seed(b: Column) -> Column:
        return placed(b, b["start"], b["stop"], b["value"], True)

    def token(t: Column) -> Column:
        lead = F.length(F.regexp_extract(t["value"], r"^[^\p{L}\p{N}]*+", 0))
        trail = F.length(F.regexp_extract(F.right(t["value"], F.lit(8)), r"[^\p{L}\p{N}]*$", 0))
        value = F.substr(t["value"], lead + 1, F.length(t["value"]) - lead - trail)
        return placed(t, t["start"] + lead, t["stop"] - trail, value, False)

    def apart(part: Column) -> Column:
        """The tokens of a run, in order, that meet no base span; only spans near the run are looked at."""
        low, high = F.element_at(part, 1)["start"], F.element_at(part, -1)["stop"]
        near = F.filter(base, lambda b: (b["start"] < high) & (low < b["stop"]))
        meets = lambda spans, t: F.exists(spans, lambda b: (b["start"] < t["stop"]) & (t["start"] < b["stop"]))
        return F.transform(F.array(near), lambda spans: F.filter(part, lambda t: ~meets(spans, t)))[0]

    found = F.flatten(F.transform(_in_runs(_matches(text, _TOKEN)), apart))
    tokens = F.when(text.rlike(_MARK), found).otherwise(_empty())
    both = F.concat(F.transform(base, seed), F.transform(tokens, token))
    return F.filter(both, lambda c: F.length(c["value"]) >= LEAST_LENGTH)


_PLACES = "array<struct<start:int,stop:int>>"


def extract(docs: DataFrame, *keep: str) -> DataFrame:
    """``keep`` columns, places of base spans by kind, candidates, and a key of the text (null without candidates)."""
    named = docs.select(*keep, F.coalesce("text", F.lit("")).alias("_text"))
    spans = named.select("*", *[base_spans(k, F.col("_text")).alias(f"_{k}") for k in KINDS])
    found = spans.withColumn("_base", F.concat(*[F.col(f"_{k}") for k in KINDS])).withColumn(
        "_candidates", _candidates(F.col("_text"), F.col("_base"))
    )
    return found.select(
        *keep,
        *[F.transform(f"_{k}", lambda s: F.struct(s["start"], s["stop"])).alias(f"_{k}") for k in KINDS],
        "_candidates",
        F.when(F.size("_candidates") > 0, F.sha2("_text", 256)).alias("_key"),
    )


def _tokens(extracted: DataFrame) -> DataFrame:
    """Candidates of each distinct text, one a row."""
    texts = extracted.filter(F.col("_key").isNotNull()).groupBy("_key").agg(F.first("_candidates").alias("c"))
    return texts.select("_key", F.explode("c").alias("t")).select("_key", "t.*")


def identifiers(extracted: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(value) of the instances that high-confidence patterns discover; seeds are not among them."""
    tokens = _tokens(extracted).select("value", "seed", F.explode("patterns").alias("p"))
    edges = durable.cut(tokens.groupBy("p.pattern", "value").agg(F.max("seed").alias("seed"), F.first("p.root").alias("root")))
    seeds = edges.groupBy("value").agg(F.max(F.col("seed").cast("int")).cast("double").alias("score"))
    score = seeds
    for _ in range(rounds):
        weighted = edges.join(score, "value")
        patterns = (
            weighted.groupBy("pattern")
            .agg(F.avg("score").alias("trust"), F.sum((F.col("score") >= ACCEPT).cast("int")).alias("n"))
            .filter((F.col("n") >= LEAST_SEEDS) & (F.col("trust") >= TRUST))
        )
        doubt = F.log(F.greatest(1 - F.col("trust"), F.lit(1e-9)))
        # A word and the two words that begin with it are one piece of evidence, not two.
        sides = edges.join(patterns, "pattern").groupBy("value", "root").agg(F.max("trust").alias("trust"))
        told = sides.groupBy("value").agg((1 - F.exp(F.sum(doubt))).alias("told"))
        score = durable.cut(
            seeds.withColumnRenamed("score", "is_seed")
            .join(told, "value", "left")
            .select("value", F.greatest("is_seed", F.coalesce("told", F.lit(0.0))).alias("score"), "is_seed")
        )
        found = score.filter((F.col("is_seed") == 0) & (F.col("score") >= ACCEPT)).select("value")
        score = score.select("value", "score")
    return found


def identifier_spans(extracted: DataFrame) -> DataFrame:
    """(_key, _id): places of discovered identifiers in each distinct text that has some.

    ``extracted`` is read several times: cut its plan first.
    """
    tokens = _tokens(extracted).filter("not seed").select("_key", "start", "stop", "value")
    places = F.sort_array(F.collect_list(F.struct("start", "stop")))
    return tokens.join(identifiers(extracted), "value").groupBy("_key").agg(places.alias("_id"))


def _join_spans(rows: DataFrame, spans: DataFrame) -> DataFrame:
    """Rows with their ``_id``; rows without a key have none and stay out of the join."""
    none = F.expr(f"cast(array() as {_PLACES})")
    plain = rows.filter(F.col("_key").isNull()).withColumn("_id", none)
    rest = rows.filter(F.col("_key").isNotNull()).join(spans, "_key", "left").withColumn("_id", F.coalesce("_id", none))
    return plain.unionByName(rest)


def _listed(kinds: list[str]) -> Column:
    def named(kind: str) -> Column:
        return F.transform(f"_{kind}", lambda s: F.concat_ws(":", F.lit(kind), s["start"].cast("string"), s["stop"].cast("string")))

    return F.array_join(F.concat(*[named(k) for k in kinds]), ",")


def find(docs: DataFrame) -> DataFrame:
    """One row per input row: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_id.

    Counts of the base kinds and their digest do not depend on the corpus; ``spans`` lists
    them and then the discovered identifiers (kind ``id``). A null text is an empty one and
    has no span. Repeated rows stay. Extra columns are ignored.
    """
    extracted = durable.cut(extract(docs.select("doc_id", "text"), "doc_id"))
    rows = _join_spans(extracted, identifier_spans(extracted))
    return rows.select(
        "doc_id",
        *[F.size(f"_{k}").cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(_listed(KINDS), 256).alias("base_sha256"),
        _listed([*KINDS, "id"]).alias("spans"),
        F.size("_id").cast("long").alias("n_id"),
    )


def mask(docs: DataFrame) -> DataFrame:
    """``docs``, all columns and rows, with every span replaced by its kind in brackets.

    Spans that overlap become one, named after the first, of those the longest. A null text stays null.
    """
    extracted = durable.cut(extract(docs.select("text")).filter(F.col("_key").isNotNull()))
    whole = docs.select(F.struct("*").alias("_row"), F.coalesce("text", F.lit("")).alias("_text"))
    spans = whole.select("*", *[base_spans(k, F.col("_text")).alias(f"_{k}") for k in KINDS])
    tokens = F.col("_text").rlike(_MARK)
    keyed = spans.withColumn("_key", F.when(tokens, F.sha2("_text", 256)))
    rows = _join_spans(keyed, identifier_spans(extracted))

    def tagged(kind: str) -> Column:
        tag = F.lit(f"[{kind.upper()}]").alias("tag")
        return F.transform(f"_{kind}", lambda s: F.struct(s["start"], (-s["stop"]).alias("before"), s["stop"], tag))

    def step(acc: Column, s: Column) -> Column:
        between = F.substr(F.col("_text"), acc["at"] + 1, s["start"] - acc["at"])
        return F.struct(
            F.greatest(acc["at"], s["stop"]).alias("at"),
            F.when(s["start"] >= acc["at"], F.concat(acc["out"], between, s["tag"])).otherwise(acc["out"]).alias("out"),
        )

    rows = rows.withColumn("_spans", F.sort_array(F.concat(*[tagged(k) for k in [*KINDS, "id"]])))
    begin = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    masked = F.aggregate(
        "_spans", begin, step, lambda acc: F.concat(acc["out"], F.substr(F.col("_text"), acc["at"] + 1, F.length(F.col("_text"))))
    )
    text = F.when(F.size("_spans") > 0, masked).otherwise(F.col("_row.text")).alias("text")
    return rows.select(*[text if c == "text" else F.col("_row")[c].alias(c) for c in docs.columns])
