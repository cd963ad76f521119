"""Licence scan by ordered signature rules, in DataFrame functions only.

A text is reduced to lower-case words joined by blanks. An index
from the first words of keywords gates the rules; those whose whole keyword occurs are run, each
giving spans; a span inside
another of higher priority (or as high and longer, or the same and earlier in the list) is
suppressed, in one sweep over sorted spans. Everything is a projection of one row, so nothing is shuffled and no row's cost
depends on another's.

Edge cases. Null text is empty: no words, no places, empty labels, score 0. Texts of any length are
read whole, in time that grows with their length and their detections. Repeated rows are
scanned each; ties between rules go to the earlier one; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .license_rules import rules

#: Phrases (words by one blank) and their labels.
BASE = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))

#: Spans that are told one by one before they go to the others as a run.
RUN = 64
_SPAN = "struct<start:int,end:int,priority:int,order:int,label:string,first:bigint,last:bigint>"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def let(value: Column, body) -> Column:
    """body of value, which is worked out once a row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words_text(text: Column) -> Column:
    """Lower-case words, each after one blank, and a closing blank; a text without words is one blank."""
    words = F.regexp_replace(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " ")
    return F.concat(F.lit(" "), F.when(F.trim(words) == "", F.lit("")).otherwise(F.concat(F.trim(words), F.lit(" "))))


def _blanks(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def _folded(items: Column, state: Column, kind: str, step) -> Column:
    """The spans that step gives, one by one, from a state of this kind and an item: struct(state, array of a span or none).

    Items go in runs of RUN: an accumulator is copied at each step, so it never holds more than a run's spans.
    """
    pair = f"struct<state:{kind},out:array<{_SPAN}>>"
    empty = lambda state: F.struct(state.alias("state"), F.array().alias("out")).cast(pair)

    def one(acc, x):
        return let(step(acc["state"], x), lambda r: F.struct(r["state"].alias("state"), F.concat(acc["out"], r["out"]).alias("out")).cast(pair))

    def run(acc, xs):
        return let(F.aggregate(xs, empty(acc["state"]), one), lambda r: F.struct(r["state"].alias("state"), F.array_append(acc["out"], r["out"]).alias("out")).cast(f"struct<state:{kind},out:array<array<{_SPAN}>>>"))

    runs = let(items, lambda all_: F.transform(F.sequence(F.lit(0), F.greatest(F.ceil(F.size(all_) / RUN) - 1, F.lit(0)).cast("int")), lambda i: F.slice(all_, i * RUN + 1, F.lit(RUN))))
    none = F.struct(state.alias("state"), F.array().alias("out")).cast(f"struct<state:{kind},out:array<array<{_SPAN}>>>")
    return F.aggregate(runs, none, run, lambda acc: F.flatten(acc["out"]))


def _spans(text: Column, r: Column) -> Column:
    """Spans of a rule: start and end in characters, priority, order, label, first word and the one after the last.

    Each match goes on where the one before it ended, so words are counted from match to match.
    """
    pattern = F.concat(F.lit(r"(?s)\G(.*?)(?<= )((?:"), r["pattern"], F.lit(")(?= ))"))
    whole, hit = F.regexp_extract_all(text, pattern, F.lit(0)), F.regexp_extract_all(text, pattern, F.lit(2))
    none = F.struct(F.lit(0).alias("at"), F.lit(0).cast("long").alias("words"))

    def step(acc, x):
        end, words = acc["at"] + F.length(x["whole"]), acc["words"] + _blanks(x["whole"])
        span = F.struct(
            (end - F.length(x["hit"])).alias("start"), end.alias("end"), r["priority"].alias("priority"), r["order"].alias("order"), r["label"].alias("label"),
            (words - _blanks(x["hit"]) - 1).alias("first"), words.alias("last"),
        )
        return F.struct(F.struct(end.alias("at"), words.alias("words")).alias("state"), F.array(span).alias("out"))

    return _folded(F.arrays_zip(whole.alias("whole"), hit.alias("hit")), none, "struct<at:int,words:bigint>", step)


def _unsuppressed(spans: Column, levels: list[int]) -> Column:
    """The spans that no stronger one contains, in one sweep.

    In the order of start, longer first, then priority, then place in the list, all spans that
    contain one and could beat it come before it; so for each priority the farthest end so far
    tells whether one does.
    """
    keyed = F.transform(spans, lambda d: F.struct(d["start"].alias("start"), (-d["end"]).alias("back"), (-d["priority"]).alias("low"), d["order"].alias("order"), d["label"].alias("label"), d["first"].alias("first"), d["last"].alias("last")))
    listed = F.array(*(F.lit(-x) for x in levels))

    def step(acc, d):
        at, end = F.array_position(listed, d["low"]).cast("int"), -d["back"]
        beaten = F.exists(F.slice(acc, F.lit(1), at), lambda e: e >= end)
        ends = F.transform(acc, lambda e, i: F.when(i + 1 == at, F.greatest(e, end)).otherwise(e))
        own = F.struct(d["start"].alias("start"), end.alias("end"), (-d["low"]).alias("priority"), d["order"].alias("order"), d["label"].alias("label"), d["first"].alias("first"), d["last"].alias("last"))
        return F.struct(ends.alias("state"), F.when(beaten, F.array()).otherwise(F.array(own)).alias("out"))

    return _folded(F.array_sort(keyed), F.array(*[F.lit(-1)] * len(levels)), "array<int>", step)


def _detect(t: Column, listed: Column, firsts: list[str], levels: list[int]) -> Column:
    """Unsuppressed spans in a words text: first words of keywords, then keywords, then patterns."""

    def run(found):
        there = F.filter(listed, lambda r: F.array_contains(found, r["first"]) & F.contains(t, r["keyword"]))
        spans = F.flatten(F.transform(there, lambda r: _spans(t, r)))
        return _unsuppressed(spans, levels)

    gate = F.array_intersect(F.split(t, " "), F.array(*map(F.lit, firsts)))
    return let(gate, lambda found: F.when(F.size(found) > 0, run(found)))


def _base(t: Column, n_words: Column, phrase: str, label: str) -> Column:
    """How often a phrase stands in a words text, its first and last start, its label; nulls where it doesn't."""
    places = let(F.split(t, f" {phrase}(?= )"), lambda parts: F.struct((F.size(parts) - 1).cast("long").alias("n"), _blanks(F.element_at(parts, 1)).cast("long").alias("first"), (n_words - (_blanks(F.element_at(parts, -1)) - 1) - len(phrase.split())).cast("long").alias("last"), F.lit(label).alias("label")))
    return F.when(F.contains(t, F.lit(f" {phrase} ")), places)


def scan(docs: DataFrame, signatures=None, base=BASE) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, detections (array of first word, word after the last, priority, label)."""
    signatures = signatures or rules()
    levels = sorted({priority for _, _, priority, _ in signatures}, reverse=True)
    firsts = sorted({k.split()[0] for _, k, _, _ in signatures})
    listed = F.array(*(F.struct(F.lit(label).alias("label"), F.lit(keyword.split()[0]).alias("first"), F.lit(f" {keyword}").alias("keyword"), F.lit(priority).alias("priority"), F.lit(pattern).alias("pattern"), F.lit(i).alias("order")) for i, (label, keyword, priority, pattern) in enumerate(signatures)))

    def all_of(t):
        n = (_blanks(t) - 1).cast("long")
        kept = F.transform(_detect(t, listed, firsts, levels), lambda d: F.struct(*(d[f].alias(f) for f in ("first", "last", "priority", "label"))))
        return F.struct(n.alias("n_words"), F.array_compact(F.array(*(_base(t, n, *b) for b in base))).alias("base"), F.coalesce(kept, F.array()).alias("detections"))

    df = docs.select("doc_id", let(words_text(F.col("text")), all_of).alias("_r")).select("doc_id", "_r.*")
    own = F.transform(F.filter("detections", lambda d: d["priority"] > 10), lambda d: d["label"])
    of = lambda name: F.transform("base", lambda b: b[name])
    total = F.aggregate(of("n"), F.lit(0).cast("long"), lambda a, x: a + x)
    surest = F.coalesce(F.array_max(F.transform("detections", lambda d: d["priority"])) / 100, F.lit(0.0))
    joined = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    return df.select("doc_id", "n_words", total.alias("n_base"), F.array_min(of("first")).alias("first_word"), F.array_max(of("last")).alias("last_word"), joined(of("label")).alias("base_labels"), joined(F.concat(of("label"), own)).alias("labels"), F.greatest(surest, F.when(F.size("base") > 0, 0.95).otherwise(0.0)).alias("score"), "detections")
