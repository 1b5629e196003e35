"""Secret scans: fixed patterns, and two character Markov models compared by likelihood.

One first-order model describes random strings, the other ordinary identifiers. Both
are counted from labelled samples of the corpus: values that the fixed patterns find,
and all other words of the same alphabet. A long token whose log-likelihood ratio exceeds a
bound is a secret too. Everything is built-in functions on the text in its row: nothing
is shuffled but the character pairs of the bounded samples.
"""

from __future__ import annotations

import math
import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The patterns of the base spans, the group that holds the value, its least length.
BASE = {
    "assign": (r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 6),
    "access": (r"AKIA[A-Z0-9]+", 0, 20),
    "hex": (r"[0-9a-f]{24,}", 0, 24),
}
KINDS = [*BASE, "markov"]
ALPHABET = string.ascii_letters + string.digits  # what is modelled; other characters part words
CANDIDATE = r"[A-Za-z0-9+/_=-]{16,}"
SPAN = "array<struct<start:int,kind:int,end:int>>"


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def running(values: Column, merge) -> Column:
    """For each element ``merge`` of all up to it, in log2(n) passes: each takes in what lies 1, 2, 4, ... places before.

    Values are non-negative, and ``merge`` (a sum, a maximum) leaves a value alone that meets 0.
    """
    def further(merged: Column, k: Column) -> Column:
        far = F.call_function("shiftleft", F.lit(1), k)
        before = F.concat(F.array_repeat(F.lit(0), far), F.slice(merged, 1, F.size(merged) - far))
        return F.zip_with(merged, before, merge)

    def all_passes(values: Column) -> Column:
        passes = F.ceil(F.log2(F.greatest(F.size(values), F.lit(1)))).cast("int")
        return F.when(passes == 0, values).otherwise(F.aggregate(F.sequence(F.lit(0), passes - 1), values, further))

    return let(values, all_passes)


def _spans(text: Column, kind: int, pattern: str, keep) -> Column:
    """Spans of the matches that ``keep(match, its value)`` holds for, in code points.

    The texts between the matches and the matches, in turn, add up to the places.
    """
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(2)) if KINDS[kind] == "assign" else matches
    # The last gap has no match behind it.
    steps = F.filter(
        F.arrays_zip(F.split(text, pattern, -1).alias("gap"), matches.alias("match"), values.alias("value")),
        lambda s: s["match"].isNotNull(),
    )

    def placed_steps(steps: Column) -> Column:
        ends = running(F.transform(steps, lambda s: F.length(s["gap"]) + F.length(s["match"])), lambda x, y: x + y)
        return F.zip_with(steps, ends, lambda s, end: F.struct(
            (end - F.length(s["match"])).alias("start"), F.lit(kind).alias("kind"), end.alias("end"), keep(s["match"], s["value"]).alias("keep"),
        ))

    placed = let(steps, placed_steps)
    return F.transform(F.filter(placed, lambda s: s["keep"]), lambda s: F.struct(s["start"], s["kind"], s["end"])).cast(SPAN)


def base_spans(text: Column) -> list[Column]:
    """For each base kind its spans, an empty array where the text has none; NULL text is empty."""
    text, none = F.coalesce(text, F.lit("")), F.array().cast(SPAN)
    out = []
    for k, (pattern, _, least) in enumerate(BASE.values()):
        spans = _spans(text, k, pattern, lambda match, value, least=least: F.length(value) >= least)
        out.append(F.when(text.rlike(pattern), spans).otherwise(none))
    return out


def _characters(token: Column) -> Column:
    """The token's characters as an array; one pass, however long it is."""
    return F.split(token, "")


def _pairs(tokens: DataFrame) -> dict[str, int]:
    """Counts of the character pairs of a column ``token``; at most the alphabet's square of rows."""
    tokens = tokens.filter(F.length("token") > 1).withColumn("c", _characters(F.col("token")))
    pairs = F.zip_with(F.slice("c", 1, F.size("c") - 1), F.slice("c", 2, F.size("c") - 1), lambda a, b: F.concat(a, b))
    counts = tokens.select(F.explode(pairs).alias("pair")).groupBy("pair").agg(F.count("*").alias("n"))
    return {r["pair"]: r["n"] for r in counts.collect()}


def log_ratios(random: dict[str, int], ordinary: dict[str, int]) -> list[float]:
    """log P(second | first) under the random model less that under the ordinary one, for each pair of the alphabet."""
    out = []
    for a in ALPHABET:
        sums = [sum(m.get(a + b, 0) for b in ALPHABET) + len(ALPHABET) for m in (random, ordinary)]
        for b in ALPHABET:
            p, q = [(m.get(a + b, 0) + 1) / s for m, s in zip((random, ordinary), sums)]
            out.append(math.log(p / q))
    return out


def samples(docs: DataFrame, sample_docs: int = 4_000) -> DataFrame:
    """(token, is_random, held_out): labelled samples, of which every fourth document is held out.

    Random strings: the values of base spans in the ``sample_docs`` documents with spans that come first by
    the hash of their id and text. Ordinary ones: the words of the alphabet, digits and paths included, of
    at least four characters in the first ``sample_docs`` documents, without base spans.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    keyed = docs.select(text.alias("text"), F.xxhash64(F.col("doc_id"), text).alias("key"))
    any_base = "|".join(f"(?:{p})" for p, _, _ in BASE.values())
    chosen = lambda rows: F.broadcast(  # noqa: E731  sample_docs keys
        rows.select("key").distinct().orderBy("key").limit(sample_docs)
    )
    secret = keyed.filter(text.rlike(any_base))
    values = F.concat(
        F.regexp_extract_all("text", F.lit(BASE["assign"][0]), F.lit(2)),
        F.regexp_extract_all("text", F.lit(BASE["access"][0]), F.lit(0)),
        F.regexp_extract_all("text", F.lit(BASE["hex"][0]), F.lit(0)),
    )
    held_out = (F.pmod("key", F.lit(4)) == 0).alias("held_out")
    random = secret.join(chosen(secret), "key").select(F.explode(values).alias("token"), F.lit(True).alias("is_random"), held_out)
    plain = F.regexp_replace("text", any_base, " ")
    words = keyed.join(chosen(keyed), "key").select(
        F.explode(F.regexp_extract_all(plain, F.lit(r"[A-Za-z0-9+/_=-]{4,}"), F.lit(0))).alias("token"),
        F.lit(False).alias("is_random"), held_out,
    )
    return random.filter(F.length("token") >= 12).unionByName(words)


def train(docs: DataFrame, sample_docs: int = 4_000) -> list[float]:
    """The table of log-likelihood ratios, from the samples that are not held out; a side without any is uniform."""
    known = samples(docs, sample_docs).filter("not held_out")
    return log_ratios(_pairs(known.filter("is_random")), _pairs(known.filter("not is_random")))


def judged(docs: DataFrame, table: list[float], least_ratio: float = 20.0, sample_docs: int = 4_000) -> dict[str, int]:
    """Held-out tokens long enough for a Markov span, by whether they are random and whether the bound calls them so."""
    long = samples(docs, sample_docs).filter(F.col("held_out") & F.col("token").rlike(f"^{CANDIDATE}$"))
    called = ratio(F.col("token"), table) >= least_ratio
    named = F.concat(F.when(called, "called_").otherwise("left_"), F.when(F.col("is_random"), "random").otherwise("ordinary"))
    counts = {r["name"]: r["n"] for r in long.groupBy(named.alias("name")).agg(F.count("*").alias("n")).collect()}
    return {name: counts.get(name, 0) for name in ("called_random", "left_random", "called_ordinary", "left_ordinary")}


def ratio(token: Column, table: list[float]) -> Column:
    """The log-likelihood ratio of a token, in one pass over its characters.

    Pairs with a character outside the alphabet say nothing: a path or a hyphenated name is as ordinary as its words.
    """
    values, alphabet, n = F.lit(table), F.lit(ALPHABET), len(ALPHABET)
    start = F.struct(F.lit(-1).alias("last"), F.lit(0.0).alias("sum"))

    def step(state: Column, character: Column) -> Column:
        place = F.position(character, alphabet) - 1
        gain = F.when((state["last"] < 0) | (place < 0), F.lit(0.0)).otherwise(F.get(values, state["last"] * n + place))
        return F.struct(place.alias("last"), (state["sum"] + gain).alias("sum"))

    return F.aggregate(_characters(token), start, step, lambda state: state["sum"])


def markov_spans(text: Column, table: list[float], least_ratio: float) -> Column:
    text = F.coalesce(text, F.lit(""))
    spans = _spans(text, len(BASE), CANDIDATE, lambda match, _: ratio(match, table) >= least_ratio)
    return F.when(text.rlike(CANDIDATE), spans).otherwise(F.array().cast(SPAN))


def apart_from(spans: Column, others: Column) -> Column:
    """The spans that touch none of the others, by one sort and a running maximum.

    In the order of their places, a span's end meets all other spans that begin before it; it
    touches one if the furthest of their ends lies behind its start.
    """
    place = lambda at, other, reach, s: F.struct(
        at.alias("at"), F.lit(other).alias("other"), reach.alias("reach"), s.alias("span")
    )

    def marked(events: Column) -> Column:
        reach = running(F.transform(events, lambda e: e["reach"]), lambda x, y: F.greatest(x, y))
        return F.zip_with(events, reach, lambda e, r: F.struct(e["span"].alias("span"), ((e["other"] == 0) & (r <= e["span"]["start"])).alias("free")))

    def free(spans: Column) -> Column:
        events = F.array_sort(F.concat(
            F.transform(spans, lambda s: place(s["end"], 0, F.lit(0), s)), F.transform(others, lambda s: place(s["start"], 1, s["end"], s)),
        ))
        apart = F.transform(F.filter(let(events, marked), lambda e: e["free"]), lambda e: e["span"])
        return F.when((F.size(spans) == 0) | (F.size(others) == 0), spans).otherwise(apart)

    return let(spans, free)


def find_secrets(docs: DataFrame, to: str, table: list[float] | None = None, least_ratio: float = 20.0) -> DataFrame:
    """``docs`` with all spans of every whole text, in column ``to``, by start and kind.

    ``table`` defaults to one trained on ``docs``. Markov spans that touch a base span are
    left out. Texts that are NULL, empty or without a match get an empty array; rows are
    independent of each other, so repeated rows and NULL ids need no care.
    """
    table = table or train(docs)
    base = F.concat(*base_spans(F.col("text")))
    rows = docs.withColumn(to, base)
    markov = apart_from(markov_spans(F.col("text"), table, least_ratio), F.col(to))
    return rows.withColumn(to, F.array_sort(F.concat(F.col(to), markov)))


def written(spans: Column) -> Column:
    """Spans as kind:start:end, comma-joined."""
    kinds = F.lit(KINDS)
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"], s["end"])), ",")


def redacted(text: Column, spans: Column, mark: str = "[secret]") -> Column:
    """The text with every span, or run of overlapping spans, replaced by a mark."""
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(state: Column, s: Column) -> Column:
        gap = F.substring(text, state["at"] + 1, F.greatest(s["start"] - state["at"], F.lit(0)))
        more = F.when(s["start"] >= state["at"], F.concat(state["out"], gap, F.lit(mark))).otherwise(state["out"])
        return F.struct(F.greatest(state["at"], s["end"]).alias("at"), more.alias("out"))

    rest = lambda s: F.concat(s["out"], F.substring(text, s["at"] + 1, F.length(text)))
    return F.when(F.size(spans) > 0, F.aggregate(spans, start, step, rest)).otherwise(text)
