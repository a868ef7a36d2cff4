"""Secret scans: known patterns, and a battery of randomness tests for tokens that no pattern names.

Base spans: each kind's leftmost non-overlapping matches, of which those that are too short are dropped. Beside them every token of
20 and more characters gets an inferred encoding (alphabet), and three tests of whether it is uniform over it: chi-squared on its
characters, runs above and below the middle of the alphabet, and serial correlation of neighbours. The p-values are combined (Fisher);
the higher, the more random the token looks.

What is reported is controlled for false discoveries, within each class of token lengths. A model of neighbouring letters, fitted on all
words of the corpus, tells tokens that its words explain better than chance (words, names, paths: ordinary) from those that they do not (odd; changes between letters and
digits speak against words too). Ordinary tokens are the null: the share of those of that length and less that look at least as random as some limit is what an odd
token that is no secret has. A class with fewer than ``LEAST_NULL`` of them borrows those of the next longer classes. The limit is the widest at which that share of all
odd tokens is at most DISCOVERY_RATE of those reported. Longer tokens are told apart better, so their limits are wider. Odd tokens within the limit that touch no base
span are added as spans of kind ``random``. With few ordinary tokens in the whole corpus (none counts as one that looks random) little or nothing is reported rather
than without control.

Scale: matches and statistics are computed within each row by SQL functions; texts are read twice and never shuffled, and work
grows with a text's length (places of n matches by prefix sums in about n^1.5 short steps). Words are counted in their tasks before letter pairs are, and the model is a
table of 26 by 26 numbers; the limits come from counts of p-value bins per length class, a table of fixed size.

Defined cases: null text is empty and has no span; a text counts as a whole however long; repeated rows get equal results and count each; of
p-values in one bin all or none are within the limit; an empty table gives an empty result; further columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cytogrid.llm.common import bind, blank_if_null, col, materialize

_KEYWORD = r"(?i:password|passwd|secret|token|api_?key)"
_ASSIGN = rf"""{_KEYWORD}["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+"""
#: (kind, pattern with the whole match as group 1, a cheap test that every match's text passes, least length, and the group it is of).
BASE = (
    ("assign", rf"""({_KEYWORD}["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))""", _KEYWORD, 12, 2),
    # a maximal run decides both: shorter matches of the open pattern would be dropped anyhow
    ("access", r"(AKIA[A-Z0-9]{14,})", r"AKIA[A-Z0-9]{14}", 18, 1),
    ("hex", r"([0-9a-f]{16,})", r"[0-9a-f]{16}", 16, 1),
)
RANDOM = "random"
#: A token: outside of assignments, and without their keywords.
CANDIDATE = rf"(?:{_ASSIGN}|((?:(?!{_KEYWORD})[A-Za-z0-9+/_-]){{20,}}=*+))"
CANDIDATE_TEST = r"[A-Za-z0-9+/_-]{20}"
#: What a token holds if it touches a base span of the other kinds.
TOUCHES = rf"{BASE[1][2]}|{BASE[2][2]}"
#: (name, pattern, alphabet); the first that fits a token is its encoding.
ENCODINGS = (
    ("hex", r"\A[0-9a-f]+\z", "0123456789abcdef"),
    ("HEX", r"\A[0-9A-F]+\z", "0123456789ABCDEF"),
    ("base32", r"\A[A-Z2-7]+\z", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    ("lower", r"\A[a-z]+\z", "abcdefghijklmnopqrstuvwxyz"),
    ("base36", r"\A[a-z0-9]+\z", "0123456789abcdefghijklmnopqrstuvwxyz"),
    ("BASE36", r"\A[A-Z0-9]+\z", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    ("letters", r"\A[A-Za-z]+\z", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"),
    ("base62", r"\A[A-Za-z0-9]+\z", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"),
    ("base64", r"\A[A-Za-z0-9+/]+\z", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
    ("base64url", r"", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_+/"),
)
#: Length classes start at these; the rate of false discoveries among the tokens reported in each.
LENGTH_CLASSES = (20, 28, 40, 64)
DISCOVERY_RATE = 0.05
#: Bins of -log10 of the combined p-value; the last is open.
BINS, BINS_PER_DECADE = 400, 20
LEAST_P = 1e-15
#: Ordinary tokens that a length class needs for a null of its own.
LEAST_NULL = 200
LETTERS = "abcdefghijklmnopqrstuvwxyz"
#: What a change between letter and digit takes from a token's score, in bits.
CHANGE = 0.5


def matches(text: Column, pattern: str, test: str, *groups: int) -> list[Column]:
    """For each group, an array of its text in each match, and first the array of the matches together with the text before them.

    A match is found together with all text since the one before it, so the lengths add up to its place; the \\G keeps a failed search
    from starting over at each character.
    """
    whole = rf"(?s)\G.*?{pattern}"
    none = F.array().cast("array<string>")
    take = lambda g: F.when(text.rlike(test), F.regexp_extract_all(text, F.lit(whole), F.lit(g))).otherwise(none)
    return [take(0), *[take(g) for g in groups]]


def running(sizes: Column) -> Column:
    """Sums of ``sizes`` (ints) up to and with each element, by blocks of about the root of their number."""

    def by_blocks(a: Column) -> Column:
        width = F.ceil(F.sqrt(F.size(a))).cast("int")
        add = lambda part: F.aggregate(part, F.lit(0), lambda s, x: s + x)
        sums = F.transform(F.sequence(F.lit(0), F.ceil(F.size(a) / width).cast("int") - 1), lambda b: add(F.slice(a, b * width + 1, width)))
        before = bind(sums, lambda t: F.transform(t, lambda x, b: add(F.slice(t, F.lit(1), b))))
        place = lambda b: F.transform(a, lambda x, i: F.get(b, F.floor(i / width).cast("int")) + add(F.slice(a, i - i % width + 1, i % width + 1)))
        return bind(before, place)

    return bind(sizes, lambda a: F.when(F.size(a) == 0, F.array().cast("array<int>")).otherwise(by_blocks(a)))


def _lengths(strings: Column) -> Column:
    return F.transform(strings, lambda s: F.length(s))


def _placed(kind: Column, found: list[Column], least: int) -> Column:
    """Array of struct(start, kind, stop) of the matches whose last group is long enough."""
    whole, match, *rest = found
    spans = F.transform(
        F.arrays_zip(running(_lengths(whole)).alias("stop"), _lengths(match).alias("m"), _lengths(rest[0] if rest else match).alias("g")),
        lambda z: F.struct((z["stop"] - z["m"]).alias("start"), kind.alias("kind"), z["stop"].alias("stop"), z["g"].alias("g")),
    )
    return F.transform(F.filter(spans, lambda x: x["g"] >= least), lambda x: F.struct(x["start"].alias("start"), x["kind"].alias("kind"), x["stop"].alias("stop")))


def _normal_tail(z: Column) -> Column:
    """P(N > z), by the rational approximation of Abramowitz and Stegun (26.2.17)."""

    def upper(a: Column) -> Column:
        t = 1 / (1 + 0.2316419 * a)
        poly = bind(t, lambda t: t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429)))))
        return F.exp(-a * a / 2) * 0.3989422804014327 * poly

    return bind(z, lambda x: bind(upper(F.abs(x)), lambda u: F.when(x >= 0, u).otherwise(1 - u)))


def battery(token: Column) -> Column:
    """Combined p-value of the three tests for a token's being uniform over its inferred encoding."""
    alphabet = reduce(lambda c, e: c.when(token.rlike(e[1]), e[2]), ENCODINGS[1:-1], F.when(token.rlike(ENCODINGS[0][1]), ENCODINGS[0][2])).otherwise(ENCODINGS[-1][2])
    zero = F.lit(0.0)

    def sums(x: Column) -> Column:
        """x: struct(a, v), alphabet and the characters' places there (double). One pass in order, one over the sorted places."""
        middle = F.length(x["a"]) / 2
        start = F.struct(F.lit(-1.0).alias("last"), *[zero.alias(c) for c in ("n", "s", "s2", "lag", "high", "turns")])

        def add(t: Column, v: Column) -> Column:
            later = t["last"] >= 0
            turned = later & ((t["last"] >= middle) != (v >= middle))
            one = lambda c: F.when(c, 1.0).otherwise(0.0)
            return F.struct(v.alias("last"), (t["n"] + 1).alias("n"), (t["s"] + v).alias("s"), (t["s2"] + v * v).alias("s2"), (t["lag"] + F.when(later, t["last"] * v).otherwise(0.0)).alias("lag"), (t["high"] + one(v >= middle)).alias("high"), (t["turns"] + one(turned)).alias("turns"))

        def count(t: Column, v: Column) -> Column:
            same = F.when(v == t["last"], t["run"] + 1).otherwise(1.0)
            # a run's square grows by 2 r - 1 with its r-th member
            return F.struct(v.alias("last"), same.alias("run"), (t["squares"] + 2 * same - 1).alias("squares"))

        squares = F.aggregate(F.array_sort(x["v"]), F.struct(F.lit(-1.0).alias("last"), zero.alias("run"), zero.alias("squares")), count, lambda t: t["squares"])
        return F.struct(F.length(x["a"]).cast("double").alias("k"), F.element_at(x["v"], 1).alias("head"), squares.alias("squares"), F.aggregate(x["v"], start, add).alias("t"))

    def tested(x: Column) -> Column:
        t, k = x["t"], x["k"]
        n, high, low, mean = t["n"], t["high"], t["n"] - t["high"], t["s"] / t["n"]
        df = k - 1
        chi = x["squares"] * k / n - n
        p_chi = _normal_tail((F.pow(F.greatest(chi, zero) / df, F.lit(1 / 3)) - (1 - 2 / (9 * df))) / F.sqrt(2 / (9 * df)))
        runs = F.struct((2 * high * low / n + 1).alias("mean"), (t["turns"] + 1).alias("runs"))
        spread = lambda r: (r["mean"] - 1) * (r["mean"] - 2) / (n - 1)
        p_runs = bind(runs, lambda r: F.when(spread(r) > 0, 2 * _normal_tail(F.abs(r["runs"] - r["mean"]) / F.sqrt(F.greatest(spread(r), F.lit(1e-9))))).otherwise(F.lit(LEAST_P)))
        around = t["s2"] - n * mean * mean
        # sum of (v[i] - mean) * (v[i - 1] - mean)
        lagged = t["lag"] - mean * (2 * t["s"] - t["last"] - x["head"]) + (n - 1) * mean * mean
        p_serial = F.when(around > 1e-9, 2 * _normal_tail(F.abs(lagged / F.greatest(around, F.lit(1e-9)) * F.sqrt(n)))).otherwise(F.lit(LEAST_P))
        half = -sum((F.log(F.least(F.greatest(p, F.lit(LEAST_P)), F.lit(1.0))) for p in (p_chi, p_runs, p_serial)), zero)
        return bind(half, lambda h: F.exp(-h) * (1 + h + h * h / 2))

    def placed(x: Column) -> Column:
        v = F.transform(F.filter(F.split(x["t"], ""), lambda c: c != ""), lambda c: (F.position(c, x["a"]) - 1).cast("double"))
        return bind(bind(F.struct(x["a"].alias("a"), v.alias("v")), sums), tested)

    return bind(F.struct(token.alias("t"), alphabet.alias("a")), placed)


def _length_class(n: Column) -> Column:
    return sum((F.when(n >= c, 1).otherwise(0) for c in LENGTH_CLASSES[1:]), F.lit(0))


def letter_pairs(texts: DataFrame) -> list[float]:
    """For each letter and the next one, how many bits more likely that is within the words of ``texts`` (text) than if all letters were; row by row of LETTERS."""
    words = texts.select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]{3,}"), F.lit(0))).alias("w")).groupBy("w").agg(F.count("*").alias("n"))
    pairs = words.select("n", F.explode(F.sequence(F.lit(1), F.length("w") - 1)).alias("i"), "w").groupBy(F.expr("substr(w, i, 2)").alias("pair")).agg(F.sum("n").alias("n"))
    seen = {r["pair"]: r["n"] for r in pairs.collect()}  # 676 rows at most
    total = {a: sum(seen.get(a + b, 0) for b in LETTERS) for a in LETTERS}
    return [math.log2(26 * (seen.get(a + b, 0) + 1) / (total[a] + 26)) for a in LETTERS for b in LETTERS]


def wordlike(token: Column, table: Column) -> Column:
    """A token's bits for being made of words: its letter pairs by ``letter_pairs``, less CHANGE for each change between letter and digit."""
    kinds = F.transform(F.filter(F.split(F.lower(token), ""), lambda c: c != ""), lambda c: F.position(c, F.lit(LETTERS + "0123456789")))

    def add(t: Column, c: Column) -> Column:
        last = t["last"]
        both = (last > 0) & (c > 0)
        pair = F.when(both & (last <= 26) & (c <= 26), F.get(table, (last - 1) * 26 + c - 1)).when(both & ((last <= 26) != (c <= 26)), -CHANGE).otherwise(0.0)
        return F.struct(c.alias("last"), (t["bits"] + pair).alias("bits"))

    return F.aggregate(kinds, F.struct(F.lit(0).alias("last"), F.lit(0.0).alias("bits")), add, lambda t: t["bits"])


def limits_of(bins: list[tuple[int, int, bool, int]], rate: float = DISCOVERY_RATE) -> list[int]:
    """Per length class the last bin that is reported (-1: none), from (class, bin, odd, number of tokens).

    Bins rise as tokens look less random. At a limit the expected number of ordinary tokens among the odd ones within it is (1 + ordinary within) / (1 + ordinary) of all odd
    ones, ordinary ones being those of that class and below, and where these are few those of the next classes too.
    """
    out, classes = [], range(len(LENGTH_CLASSES))
    size = [sum(n for cls, _, odd, n in bins if not odd and cls == c) for c in classes]
    for c in classes:
        last = next((e for e in classes if e >= c and sum(size[: e + 1]) >= LEAST_NULL), len(LENGTH_CLASSES) - 1)
        mixed, plain = [0] * (BINS + 1), [0] * (BINS + 1)
        for cls, b, is_odd, n in bins:
            if is_odd and cls == c:
                mixed[b] += n
            elif not is_odd and cls <= last:
                plain[b] += n
        limit, seen, null = -1, 0, 0
        for b in range(BINS + 1):
            seen, null = seen + mixed[b], null + plain[b]
            if seen and sum(mixed) * (1 + null) / (1 + sum(plain)) <= rate * seen:
                limit = b
        out.append(limit)
    return out


def spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rate: float = DISCOVERY_RATE) -> DataFrame:
    """Per row: id, ``base`` and ``added``, arrays of struct(start, kind, stop) in order; kind numbers as in BASE, then RANDOM."""
    text = F.col("text")
    t = docs.select(col(id_col).alias("id"), blank_if_null(col(text_col)).alias("text"))
    base = F.sort_array(F.concat(*[_placed(F.lit(i), matches(text, pattern, test, *range(1, group + 1)), least) for i, (_, pattern, test, least, group) in enumerate(BASE)]))
    whole, token = matches(text, CANDIDATE, CANDIDATE_TEST, 1)
    tokens = F.transform(F.arrays_zip(running(_lengths(whole)).alias("stop"), token.alias("m")), lambda z: F.struct((z["stop"] - F.length(z["m"])).alias("start"), z["stop"].alias("stop"), z["m"].alias("m")))
    free = F.filter(tokens, lambda x: (x["m"] != "") & ~x["m"].rlike(TOUCHES))

    # one row of 676 numbers, as a column: an array of literals would be made anew for each letter
    t = t.crossJoin(F.broadcast(docs.sparkSession.createDataFrame([(letter_pairs(t),)], "pairs array<double>")))

    def scored(x: Column) -> Column:
        bare = F.regexp_replace(x["m"], "=+$", "")
        odd = x["m"].rlike("[A-Za-z]") & (wordlike(bare, F.col("pairs")) < 0)
        decades = -F.log10(F.greatest(battery(bare), F.lit(1e-30)))
        return F.struct(x["start"].alias("start"), x["stop"].alias("stop"), _length_class(F.length(bare)).alias("cls"), odd.alias("odd"), F.least(F.floor(F.greatest(decades, F.lit(0.0)) * BINS_PER_DECADE), F.lit(BINS)).cast("int").alias("bin"))

    t = materialize(t.select("id", base.alias("base"), F.transform(free, scored).alias("scored")))
    bins = t.select(F.explode("scored").alias("x")).groupBy("x.cls", "x.bin", "x.odd").agg(F.count("*").alias("n"))
    limits = limits_of([(r["cls"], r["bin"], r["odd"], r["n"]) for r in bins.collect()], rate)  # a fixed number of bins
    kept = F.filter("scored", lambda x: x["odd"] & (x["bin"] <= F.get(F.array(*map(F.lit, limits)), x["cls"])))
    added = F.transform(kept, lambda x: F.struct(x["start"].alias("start"), F.lit(len(BASE)).alias("kind"), x["stop"].alias("stop")))
    return t.select(F.col("id").alias(id_col), "base", added.alias("added"))


def written(spans_: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    names = F.array(*[F.lit(b[0]) for b in BASE], F.lit(RANDOM))
    return F.array_join(F.transform(spans_, lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"].cast("string"), x["stop"].cast("string"))), ",")


def count_kind(spans_: Column, kind: int) -> Column:
    return F.size(F.filter(spans_, lambda x: x["kind"] == kind)).cast("long")
