"""License scan: ordered signature rules over whole texts (DataFrame functions only).

A text is looked at in three steps, all inside the row: the keyword prefilter
keeps the rules whose keywords the lower-cased text contains; the text of the few
rows with such rules is brought into canonical words; each of these rules'
patterns is run over it, and every match becomes a detection (first word, end
word, priority, label). A detection is suppressed if another one of the same or
higher priority (a smaller number) spans all its words; of equal spans and
priorities the earlier rule stays. Overlaps in which neither spans the other stay.

Base rules are phrases whose places are all counted, suppressed or not.

Nothing is shuffled: a row's result depends on its own text only.

Edge cases: null and empty texts have no words, labels or places and score 0;
repeated rows get equal results; an empty table gives an empty result; other
columns are kept, and result names that clash get underscores in front.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .columns import fresh
from .license_rules import CONFIDENCE, Rule, build_rules

CHUNK = 256
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # after A-Z are lower-cased
WORD_ANY_CASE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_RULES = ("array<struct<keywords:array<string>,pattern:string,label:string,rule_id:string,priority:int,place:int,"
          "base:boolean>>")
_DETECTION = "struct<start:bigint,neg_end:bigint,priority:int,place:int,label:string,rule_id:string,base:boolean>"


def canonical(text: Column) -> Column:
    """Lower-case words with a space on each side."""
    words = F.regexp_extract_all(F.translate(text, _UPPER, _LOWER), F.lit(WORD), F.lit(0))
    return F.concat(F.lit(" "), F.array_join(words, "  "), F.lit(" "))


def _words_in(piece: Column) -> Column:
    return ((F.length(piece) - F.length(F.replace(piece, F.lit(" "), F.lit("")))) / 2).cast("bigint")


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), body), 0)


def _chunks(array: Column) -> Column:
    """The array in pieces of ``CHUNK`` entries."""
    places = F.when(F.size(array) > 0, F.sequence(F.lit(0), F.floor((F.size(array) - 1) / CHUNK).cast("int"))).otherwise(F.array().cast("array<int>"))
    return F.transform(places, lambda i: F.slice(array, i * CHUNK + 1, F.lit(CHUNK)))


def _scan(array: Column, first: Column, total, merge, walk) -> Column:
    """One pass over an array with a state, entry by entry, in time linear in its length.

    ``total(chunk)`` is what a chunk adds to the state, ``merge(state, that)`` the state after it, ``walk(chunk, state)`` the
    chunk's results from the state before it. An array that grew entry by entry would be copied for each; here no more
    than a chunk of results, or one state per chunk, ever grows.
    """
    def states(chunks: Column) -> Column:
        start = F.struct(first.alias("at"), F.array(first).alias("all"))
        step = lambda acc, c: _let(merge(acc["at"], total(c)), lambda s: F.struct(s.alias("at"), F.concat(acc["all"], F.array(s)).alias("all")))
        return F.aggregate(chunks, start, step, lambda acc: acc["all"])

    def walked(x: Column) -> Column:
        return F.flatten(F.transform(x["chunks"], lambda c, i: walk(c, F.get(x["states"], i))))

    return _let(_chunks(array), lambda chunks: _let(F.struct(chunks.alias("chunks"), states(chunks).alias("states")), walked))


def _sums_before(array: Column) -> Column:
    """Sum of all entries before each (bigints)."""
    zero = F.lit(0).cast("bigint")

    def walk(chunk: Column, state: Column) -> Column:
        start = F.struct(state.alias("at"), F.array().cast("array<bigint>").alias("all"))
        return F.aggregate(chunk, start, lambda acc, x: F.struct((acc["at"] + x).alias("at"), F.concat(acc["all"], F.array(acc["at"])).alias("all")),
                           lambda acc: acc["all"])

    return _scan(array, zero, lambda c: F.aggregate(c, zero, lambda a, x: a + x), lambda s, t: s + t, walk)


def _detections(canon: Column, rule: Column) -> Column:
    """All matches of one rule, with word positions summed up from the pieces between them."""
    hits = F.regexp_extract_all(canon, rule["pattern"], F.lit(0))
    gaps = lambda n: F.transform(F.slice(F.split(canon, rule["pattern"], -1), F.lit(1), n), _words_in)
    sizes = _let(hits, lambda h: F.struct(F.transform(h, _words_in).alias("inside"), F.when(F.size(h) > 0, gaps(F.size(h))).alias("gap")))

    def places(x: Column) -> Column:
        def one(before: Column, i: Column) -> Column:
            start = before + F.get(x["gap"], i)
            return F.struct(start.alias("start"), (-(start + F.get(x["inside"], i))).alias("neg_end"), rule["priority"].alias("priority"),
                            rule["place"].alias("place"), rule["label"].alias("label"), rule["rule_id"].alias("rule_id"),
                            rule["base"].alias("base")).cast(_DETECTION)

        return F.transform(_sums_before(F.zip_with(x["gap"], x["inside"], lambda g, n: g + n)), one)

    none = F.array().cast(f"array<{_DETECTION}>")
    return _let(sizes, lambda x: F.when(F.size(x["inside"]) > 0, places(x)).otherwise(none))


def unsuppressed(sorted_detections: Column) -> Column:
    """One sweep over detections sorted by (start, -end, priority, place).

    Whatever comes earlier starts no later, so a detection is spanned by an
    earlier one of priority p exactly if the largest end seen with p or less reaches its
    own end.
    """
    levels = sorted(CONFIDENCE)
    none = F.lit(-1).cast("bigint")
    first = F.struct(*[none.alias(f"end{p}") for p in levels])  # largest end seen with each priority

    def seen(state: Column, d: Column) -> Column:
        return F.struct(*[F.when(d["priority"] == p, F.greatest(state[f"end{p}"], -d["neg_end"])).otherwise(state[f"end{p}"]).alias(f"end{p}") for p in levels])

    def spanned(state: Column, d: Column) -> Column:
        out = F.lit(False)
        for p in levels:
            out = out | ((d["priority"] >= p) & (state[f"end{p}"] >= -d["neg_end"]))
        return out

    def walk(chunk: Column, state: Column) -> Column:
        start = F.struct(state.alias("at"), F.array().cast("array<boolean>").alias("all"))
        return F.aggregate(chunk, start, lambda acc, d: F.struct(seen(acc["at"], d).alias("at"), F.concat(acc["all"], F.array(spanned(acc["at"], d))).alias("all")),
                           lambda acc: acc["all"])

    merge = lambda s, t: F.struct(*[F.greatest(s[f"end{p}"], t[f"end{p}"]).alias(f"end{p}") for p in levels])
    gone = _scan(sorted_detections, first, lambda c: F.aggregate(c, first, seen), merge, walk)
    return _let(gone, lambda g: F.filter(sorted_detections, lambda d, i: ~F.get(g, i)))


def scan_licenses(docs: DataFrame, text_col: str = "text", rules: Sequence[Rule] | None = None) -> DataFrame:
    """``docs`` with n_words, ``detections`` (all, sorted) and ``licenses`` (those not suppressed)."""
    rules = build_rules() if rules is None else tuple(rules)
    anchors = F.array(*[F.lit(a) for a in dict.fromkeys(r.keywords[0] for r in rules)])
    # one JSON literal instead of thousands of literal expressions; Spark folds it into a constant
    listed = [{"keywords": list(r.keywords), "pattern": r.pattern, "label": r.label, "rule_id": r.rule_id,
               "priority": r.priority, "place": i, "base": r.base} for i, r in enumerate(rules)]
    table = F.from_json(F.lit(json.dumps(listed)), _RULES)
    lower, present, tried, canon = (fresh(docs.columns, c) for c in ("_lower", "_present", "_tried", "_canon"))
    names = {c: fresh(docs.columns, c) for c in ("n_words", "detections", "licenses")}
    # each helper column is read more than once by the next step, which keeps Spark from inlining it into a lambda
    rows = docs.withColumn(lower, F.lower(F.coalesce(text_col, F.lit(""))))
    # each anchor is looked for once, not once per rule; only rules with a present anchor look for their other keywords
    rows = rows.withColumn(present, F.filter(anchors, lambda a: F.contains(F.col(lower), a)))
    passing = F.filter(table, lambda r: F.array_contains(F.col(present), F.get(r["keywords"], F.lit(0)))
                       & F.forall(r["keywords"], lambda k: F.contains(F.col(lower), k)))
    rows = rows.withColumn(tried, F.when(F.size(present) > 0, passing))
    some = F.coalesce(F.size(tried), F.lit(0)) > 0
    rows = rows.withColumn(canon, F.when(some, canonical(F.col(text_col))))
    found = F.sort_array(F.flatten(F.transform(tried, lambda r: _detections(F.col(canon), r))))
    empty = F.array().cast(f"array<{_DETECTION}>")
    rows = rows.withColumn(names["detections"], F.when(some, found).otherwise(empty))
    rows = rows.withColumn(names["licenses"], F.when(F.size(names["detections"]) > 0, unsuppressed(F.col(names["detections"])))
                           .otherwise(empty))
    n_words = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD_ANY_CASE)), F.lit(0)).cast("long")
    return rows.withColumn(names["n_words"], n_words).drop(lower, present, tried, canon)


def confidence(licenses: Column) -> Column:
    """Largest confidence of the detections that stay; 0 without any."""
    table = F.create_map(*[x for p, c in CONFIDENCE.items() for x in (F.lit(p), F.lit(c))])
    return F.coalesce(F.array_max(F.transform(licenses, lambda d: F.element_at(table, d["priority"]))), F.lit(0.0))
