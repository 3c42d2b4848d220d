"""Secret scans with DataFrame functions only: fixed patterns, and windows of high Shannon entropy.

Matches are cut out with the regular-expression functions; their places follow from the lengths of the matches and of
the pieces between them. Long strings of key-like characters are candidates for the entropy scan: a window slides over
them one character at a time, and the sum of n * log2(n) over its character counts is kept up to date with the count of
the character that leaves and of the one that enters. Limits depend on the character class of the candidate.
"""

from __future__ import annotations

from collections.abc import Callable
from math import log2
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values: the patterns of the base kinds
ASSIGN = (
    r"""((?i)password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ASSIGN_VALUE = 8
ACCESS = "AKIA[A-Z0-9]{12,}"
HEX = "[0-9a-f]{32,}"
# ---
KINDS = ("assign", "access", "hex", "entropy")


class CharClass(NamedTuple):
    pattern: str  # of the whole candidate
    limit: float  # bits per character that a window must reach


WINDOW = 20
CANDIDATE = f"[A-Za-z0-9+/_=-]{{{WINDOW},}}"
# words of sample keys; a candidate with such words is cut into what lies before, between and after them
SAMPLES = "(?i:example|sample|placeholder|xxxx)"
PIECE = f"{SAMPLES}|(?:(?!{SAMPLES}).){{{WINDOW},}}+"
# the first class that fits counts; letters alone and digits alone are no candidates
CLASSES = (
    CharClass(r"^[0-9a-fA-F]+$", 3.0),
    CharClass(r"^[A-Za-z0-9]+$", 3.7),
    CharClass(r"^[A-Za-z0-9+/_=-]+$", 3.9),
)
# candidates that are no secrets: identifiers of the 8-4-4-4-12 form, words joined by signs, dates, and rows of signs
ALLOWED = (
    r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",
    r"^[A-Za-z_/=+-]*+[0-9]{0,4}$",
    r"^[0-9_/=+-]+$",
    r"(?i)0123456789|1234567890|abcdefghij",
)

_SPANS = "array<struct<start:int,stop:int,hit:string>>"
_BLOCK = 256


def _chained(parts: Column, at: Column) -> Column:
    """Spans of consecutive (gap, hit) pairs, the first gap starting at `at`."""
    start = F.struct(at.cast("int").alias("at"), F.array().cast(_SPANS).alias("out"))

    def step(acc: Column, x: Column) -> Column:
        first = acc["at"] + F.char_length(x["gap"])
        last = first + F.char_length(x["hit"])
        span = F.struct(first.alias("start"), last.alias("stop"), x["hit"].alias("hit"))
        return F.struct(last.alias("at"), F.concat(acc["out"], F.array(span)).alias("out"))

    return F.aggregate(parts, start, step, lambda acc: acc["out"])


def matches(text: Column, pattern: str) -> Column:
    """All leftmost matches that do not overlap: start and stop in code points, and the matched string.

    Pairs of gap and match are added up in blocks, as a list that grows is copied at each step.
    """
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    parts = F.zip_with(F.split(text, pattern, -1), hits, lambda g, h: F.struct(g.alias("gap"), h.alias("hit")))
    parts = F.slice(parts, F.lit(1), F.size(hits))  # the last gap has no match after it
    blocks = F.transform(
        F.sequence(F.lit(0), F.greatest(F.size(hits) - 1, F.lit(0)), F.lit(_BLOCK)),
        lambda k: F.slice(parts, k + 1, F.lit(_BLOCK)),
    )
    start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{_SPANS}>").alias("out"))

    def step(acc: Column, block: Column) -> Column:
        out = _chained(block, acc["at"])
        end = F.coalesce(F.element_at(out, -1)["stop"], acc["at"])
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(out)).alias("out"))

    found = F.aggregate(blocks, start, step, lambda acc: F.flatten(acc["out"]))
    return F.when(text.rlike(pattern), found).otherwise(F.array().cast(_SPANS))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is worked out once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _count(window: Column, char: Column) -> Column:
    return F.char_length(window) - F.char_length(F.replace(window, char, F.lit("")))


def _weight(n: int) -> float:
    return n * log2(n) if n else 0.0


def window_limits(text: Column, limit: Column, width: int = WINDOW) -> Column:
    """Start of the first and stop of the last window with at least `limit` bits per character; null if there is none.

    Reaching a character takes time in proportion to its place, so long strings are given in blocks.
    """
    # the entropy of a window of w characters is log2(w) - sum(n * log2(n)) / w
    most = (F.lit(log2(width)) - limit) * width + 1e-9
    first = F.substring(text, 1, width)
    # what a character's count of n adds to the sum when it becomes n + 1
    gains = F.array(*[F.lit(_weight(n + 1) - _weight(n)) for n in range(width + 1)])
    weights = F.array(*[F.lit(_weight(n)) for n in range(width + 1)])
    total = F.aggregate(
        F.array_distinct(F.split(first, "")), F.lit(0.0), lambda acc, c: acc + F.get(weights, _count(first, c))
    )
    none = F.lit(None).cast("int")

    def started(total: Column) -> Column:
        hit = (F.char_length(text) >= width) & (total <= most)
        return F.struct(
            total.alias("sum"),
            F.when(hit, F.lit(0)).otherwise(none).alias("start"),
            F.when(hit, F.lit(width)).otherwise(none).alias("stop"),
        )

    def step(acc: Column, i: Column) -> Column:
        """The window moves from i - 1 to i."""
        leaves, enters = F.substr(text, i, F.lit(1)), F.substr(text, i + width, F.lit(1))
        rest = F.substr(text, i + 1, F.lit(width - 1))
        now = acc["sum"] - F.get(gains, _count(rest, leaves)) + F.get(gains, _count(rest, enters))

        def moved(now: Column) -> Column:
            hit = now <= most
            return F.struct(
                now.alias("sum"),
                F.when(hit, F.coalesce(acc["start"], i)).otherwise(acc["start"]).alias("start"),
                F.when(hit, i + width).otherwise(acc["stop"]).alias("stop"),
            )

        return _let(now, moved)

    moves = F.when(F.char_length(text) > width, F.sequence(F.lit(1), F.char_length(text) - width)).otherwise(
        F.array().cast("array<int>")
    )
    return F.aggregate(moves, _let(total, started), step, lambda acc: F.struct(acc["start"], acc["stop"]))


def _in_blocks(hit: Column, width: int = WINDOW) -> Column:
    """The string cut into blocks of _BLOCK characters, each followed by what the windows that start in it reach into."""
    parts = F.regexp_extract_all(hit, F.lit(f".{{1,{_BLOCK}}}"), F.lit(0))
    after = F.slice(parts, F.lit(2), F.greatest(F.size(parts), F.lit(1)))
    return F.zip_with(parts, after, lambda p, q: F.concat(p, F.coalesce(F.substring(q, 1, width - 1), F.lit(""))))


def _without_samples(candidates: Column) -> Column:
    def cut(x: Column) -> Column:
        def moved(y: Column) -> Column:
            return F.struct(
                (x["start"] + y["start"]).alias("start"), (x["start"] + y["stop"]).alias("stop"), y["hit"].alias("hit")
            )

        return F.when(x["hit"].rlike(SAMPLES), F.transform(matches(x["hit"], PIECE), moved)).otherwise(F.array(x))

    return F.flatten(F.transform(candidates, cut))


def entropy_spans(candidates: Column) -> Column:
    """Of each candidate that is not on the allow list, the part covered by windows of high entropy.

    Takes time in proportion to the length of a candidate: its class is found once, and it is scanned in blocks.
    """

    def class_limit(hit: Column) -> Column:
        out = F.lit(99.0)
        for c in reversed(CLASSES):
            out = F.when(hit.rlike(c.pattern), F.lit(c.limit)).otherwise(out)
        return out

    def suspicious(x: Column) -> Column:
        ok = (F.char_length(x["hit"]) >= WINDOW) & x["hit"].rlike("[0-9]") & x["hit"].rlike("[A-Za-z]")
        for p in ALLOWED:
            ok = ok & ~x["hit"].rlike(p)
        return ok

    def limited(x: Column) -> Column:
        return F.struct(x["start"].alias("start"), x["hit"].alias("hit"), class_limit(x["hit"]).alias("limit"))

    def located(x: Column) -> Column:
        none = F.lit(None).cast("int")
        inner = F.transform(_in_blocks(x["hit"]), lambda block: window_limits(block, x["limit"]))
        placed = F.transform(
            inner, lambda w, i: F.struct((w["start"] + i * _BLOCK).alias("start"), (w["stop"] + i * _BLOCK).alias("stop"))
        )
        return F.aggregate(
            placed,
            F.struct(none.alias("start"), none.alias("stop")),
            lambda acc, w: F.struct(
                F.least(acc["start"], w["start"]).alias("start"), F.greatest(acc["stop"], w["stop"]).alias("stop")
            ),
            lambda acc: F.struct(
                (x["start"] + acc["start"]).alias("start"), (x["start"] + acc["stop"]).alias("stop"), x["hit"].alias("hit")
            ),
        )

    scanned = F.transform(F.transform(F.filter(_without_samples(candidates), suspicious), limited), located)
    return F.filter(scanned, lambda x: x["start"].isNotNull())


def _found(docs: DataFrame) -> DataFrame:
    """Adds `found`: all spans as (start, kind number, stop), in order."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    spans = docs.select(
        "*",
        F.struct(
            F.filter(
                matches(text, ASSIGN), lambda x: F.char_length(F.regexp_extract(x["hit"], ASSIGN, 2)) >= ASSIGN_VALUE
            ).alias("assign"),
            matches(text, ACCESS).alias("access"),
            matches(text, HEX).alias("hex"),
            entropy_spans(matches(text, CANDIDATE)).alias("entropy"),
        ).alias("found"),
    )

    def numbered(kind: str) -> Column:
        return F.transform(
            F.col("found")[kind],
            lambda x: F.struct(x["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"), x["stop"].alias("stop")),
        )

    base = F.concat(*[numbered(k) for k in KINDS[:3]])
    added = F.filter(
        numbered("entropy"),
        lambda x: ~F.exists(base, lambda b: (b["start"] <= x["start"]) & (x["stop"] <= b["stop"])),
    )
    return spans.withColumn("found", F.array_sort(F.concat(base, added)))


def _listed(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.concat_ws(
        ",", F.transform(spans, lambda x: F.concat_ws(":", names[x["kind"]], x["start"], x["stop"]))
    )


def secret_spans(docs: DataFrame) -> DataFrame:
    """One row per row of `docs` (doc_id, text) with the counts of each kind and all spans in code points.

    A null text is empty and has no spans; other columns are ignored, repeated rows are scanned alike. Spans of high
    entropy inside a span of another kind are not repeated. Nothing is shuffled.
    """
    found = _found(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))

    def count(kind: int) -> Column:
        return F.size(F.filter("found", lambda x: x["kind"] == kind)).cast("long")

    return found.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(_listed(F.filter("found", lambda x: x["kind"] < 3)), 256).alias("base_sha256"),
        _listed(F.col("found")).alias("spans"),
        count(3).alias("n_entropy"),
    )


MASK = "[SECRET]"


def mask_secrets(docs: DataFrame) -> DataFrame:
    """The rows of `docs` with every span, or run of overlapping spans, replaced by MASK; texts without any are unchanged.

    `n_chars`, where there is such a column, becomes the new length of a changed text. Columns keep names and order.
    """
    names = docs.columns
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    text = F.col(f"c{names.index('text')}")
    found = _found(plain.withColumn("text", text)).withColumn(
        "merged",
        F.aggregate(
            "found",
            F.array().cast("array<struct<start:int,stop:int>>"),
            lambda acc, x: F.when(
                (F.size(acc) > 0) & (x["start"] < F.element_at(acc, -1)["stop"]),
                F.concat(
                    F.slice(acc, F.lit(1), F.size(acc) - 1),
                    F.array(
                        F.struct(
                            F.element_at(acc, -1)["start"].alias("start"),
                            F.greatest(F.element_at(acc, -1)["stop"], x["stop"]).alias("stop"),
                        )
                    ),
                ),
            ).otherwise(F.concat(acc, F.array(F.struct(x["start"].alias("start"), x["stop"].alias("stop"))))),
        ),
    )
    starts = F.concat(F.array(F.lit(0)), F.transform("merged", lambda x: x["stop"]))
    stops = F.concat(F.transform("merged", lambda x: x["start"]), F.array(F.char_length("text")))
    pieces = F.zip_with(starts, stops, lambda a, b: F.substr(F.col("text"), a + 1, b - a))
    masked = found.withColumn(
        "masked", F.when(F.size("merged") > 0, F.concat_ws(MASK, pieces)).otherwise(F.col("text"))
    )
    out = []
    for i, name in enumerate(names):
        c = F.col(f"c{i}")
        if name == "text":
            c = F.col("masked")
        elif name == "n_chars":
            c = F.when(F.size("merged") > 0, F.char_length("masked")).otherwise(c).cast(docs.schema[i].dataType)
        out.append(c.alias(name))
    return masked.select(*out)
