"""License scan, source mixing, URL filter, chat formatting: odd rows, and brute force in plain Python."""

import math
import random
import re
import time

import pytest
from conftest import SF_SMALL
from odd_rows import empty, odd  # noqa: F401  (fixtures)
from pyspark.sql import functions as F

from cardlens.llm import chat_format, license_scan, mixing, url_filter
from cardlens.llm.columns import space_word_count
from cardlens.llm.license_rules import GENERIC, IDENTIFIER, NAMED, VERSIONED, Rule, build_rules

CLASH_CHECK = ["score", "copy", "licenses", "n_words", "hash"]


def kept(rows):
    return all(r[c] == f"own {c}" for r in rows for c in CLASH_CHECK)


# ---- license scan ----------------------------------------------------------

def test_rules_are_hundreds_with_keywords_that_their_texts_contain():
    rules = build_rules()
    assert len(rules) > 200 and len({r.rule_id for r in rules}) == len(rules)
    for r in rules:
        re.compile(r.pattern)
        sample = re.sub(r"\(\?:([^|()]*)(?:\|[^()]*)?\)\??", r"\1", r.signature)  # first alternatives
        joined = sample.replace(" ", "").replace("[cs]", "s").replace("[0-9]", "1").replace("?", "")
        assert all(k in joined for k in r.keywords if "[" not in k), (r.rule_id, r.keywords, joined)


def _words(text):
    lower = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def _brute(text, rules):
    words = _words(text)
    canon = " " + "  ".join(words) + " "
    found = []
    for place, r in enumerate(rules):
        for m in re.finditer(r.pattern, canon):
            start = canon[:m.start()].count(" ") // 2
            found.append((start, start + m[0].count(" ") // 2, r.priority, place, r.label))
    stay = [d for d in found if not any(
        e[0] <= d[0] and e[1] >= d[1] and e[2] <= d[2] and (e[0] < d[0] or e[1] > d[1] or e[2] < d[2] or e[3] < d[3]) for e in found)]
    return sorted(found), sorted(stay)


RULES = (Rule("a", ("x",), "x y", "xy", GENERIC), Rule("b", ("x",), "x y z", "xyz", NAMED), Rule("c", ("y",), "y z", "yz", VERSIONED),
         Rule("d", ("z",), "z", "z", IDENTIFIER), Rule("e", ("x",), "x(?: y)? z?", "opt", GENERIC), Rule("f", ("y",), "y", "y1", NAMED))


def test_scan_equals_brute_force_on_random_texts(spark):
    r = random.Random(1)
    texts = ["".join(r.choice(["x", "y", "z", "w", "X"]) + r.choice([" ", "-", ". "]) for _ in range(r.randrange(0, 14))) for _ in range(300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for row in license_scan.scan_licenses(docs, rules=RULES).collect():
        every, stay = _brute(row.text, RULES)
        plain = lambda ds: sorted((d.start, -d.neg_end, d.priority, d.place, d.label) for d in ds)
        assert plain(row.detections) == every and plain(row.licenses) == stay
        assert row.n_words == len(_words(row.text))


def test_many_hits_in_one_text(spark):
    """Hundreds of chunks of detections: positions and suppression as by brute force, and time in proportion."""
    r = random.Random(11)
    texts = [" ".join(r.choice(["x y", "x y z", "y z", "z", "w w"]) for _ in range(n)) for n in (255, 256, 257, 700)]
    for row in license_scan.scan_licenses(spark.createDataFrame([(t,) for t in texts], "text string"), rules=RULES).collect():
        every, stay = _brute(row.text, RULES)
        plain = lambda ds: sorted((d.start, -d.neg_end, d.priority, d.place, d.label) for d in ds)
        assert plain(row.detections) == every and plain(row.licenses) == stay

    def seconds(n):
        docs = spark.createDataFrame([("cc by " * n,)], "text string")
        start = time.perf_counter()
        found = license_scan.scan_licenses(docs).select(F.size("detections"), F.size("licenses")).first()
        assert tuple(found) == (2 * n, n)
        return time.perf_counter() - start

    seconds(1000)
    assert seconds(16_000) < 2.5 * seconds(8_000) + 1


LICENSE_LINES = [
    ("Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software", {"bsl-1.0"}),
    ("to deal in the Software without restriction, including", {"mit"}),
    ("Redistributions of source code must retain the above\n copyright notice", {"bsd"}),
    ("you can redistribute it and/or modify it under the terms of the GNU Affero General Public License", {"gpl", "agpl"}),
    ("either version 2.1 of the License, or (at your option) any later version", {"or-later"}),
    ("Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", {"mpl-2.0"}),
    ("You must give appropriate credit, provide a link to the license, and", {"cc"}),
    ("The Llama 3.1 Community License Agreement", {"llama"}),
    ("Unauthorised copying of this file", {"proprietary"}),
    ("No part of this publication may be reproduced without the prior written permission of the publisher", {"no-reproduction"}),
    ("Tous droits r\u00e9serv\u00e9s. Alle Rechte vorbehalten!", {"all-rights-reserved"}),
    ("you can do what you want with it and share it with your friends, for a year or so", set()),
]


def test_sentences_of_license_texts(spark):
    """Sentences are found over line breaks and punctuation; what a longer one spans is suppressed, base places stay."""
    rules = build_rules()
    single = [r for r in rules if not r.rule_id.startswith(("spdx-", "name-", "under-", "cc-long-", "cc-url-", "family-", "short-"))]
    assert len(single) > 130
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(LICENSE_LINES)], "doc_id long, text string")
    for row in license_scan.scan_licenses(docs).collect():
        every, stay = _brute(row.text, rules)
        plain = lambda ds: sorted((d.start, -d.neg_end, d.priority, d.place, d.label) for d in ds)
        assert plain(row.detections) == every and plain(row.licenses) == stay
        labels = {d.label for d in row.licenses} | {d.label for d in row.detections if d.base}
        assert labels == LICENSE_LINES[row.doc_id][1], (row.text, labels)


def test_scan_of_odd_rows(odd, empty):
    rows = license_scan.scan_licenses(odd).collect()
    assert len(rows) == odd.count() and kept(rows)
    one = {r.doc_id: r for r in rows}
    assert {"mit", "reserved", "copyright"} <= {d.label for d in one[1].detections}
    assert not one[2].detections and one[2]["_n_words"] == 0 and one[5]["_n_words"] == 100_000
    assert sum(d.base for d in one[9].detections) == 2  # U+00A0 belongs to a word, so 'Cc/By\u00a0cc' is no phrase
    assert license_scan.scan_licenses(empty).count() == 0


# ---- mixing ----------------------------------------------------------------

def _targets(sizes, weights, cap):
    """Water filling by repeated sharing."""
    left, open_, target = float(sum(sizes.values())), dict(sizes), {}
    while open_:
        total = sum(weights[s] for s in open_)
        full = [s for s in open_ if left * weights[s] / total >= cap * sizes[s]]
        if not full:
            target.update({s: left * weights[s] / total for s in open_})
            break
        for s in full:
            target[s] = float(cap * sizes[s])
        left -= sum(target[s] for s in full)
        for s in full:
            del open_[s]
    return target


def test_targets_and_copies(spark):
    r = random.Random(2)
    rows = [(i, r.choice(["a", "b", "b", "b", "b", "c", None]), r.randrange(0, 60)) for i in range(3000)] + [(-1, "z", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, size long")
    got = mixing.copy_counts(docs, "doc_id", "source", "size").collect()
    sizes = {}
    for _, s, n in rows:
        sizes[s] = sizes.get(s, 0) + n
    order = sorted((s for s in sizes if s is not None)) + [None]
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    want = _targets(sizes, weights, 3)
    taken = {}
    for g in got:
        assert g.target == pytest.approx(want[g.source]) and g.source_size == sizes[g.source] and 0 <= g.copies <= 3
        assert abs(g.copies - g.target / max(g.source_size, 1)) < 1
        taken[g.source] = taken.get(g.source, 0) + g.copies * g.size
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 61, (s, taken[s], want[s])
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, mixing.copy_counts(docs, "doc_id", "source", "size").collect()), key=str)


def test_many_sources_are_cut_into_ranges(spark, monkeypatch):
    """Sources like hosts, many of one size: the ranges give the weights, targets and draws of the one window, to the last bit."""
    r = random.Random(5)
    rows = [(i, None if i % 97 == 0 else f"host{r.randrange(400)}", r.choice([0, 3, 3, 3, 8, 200])) for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, size long")
    window = sorted(map(tuple, mixing.copy_counts(docs, "doc_id", "source", "size").collect()), key=str)
    monkeypatch.setattr(mixing, "SMALL_SOURCES", 10)
    assert sorted(map(tuple, mixing.copy_counts(docs, "doc_id", "source", "size").collect()), key=str) == window
    sizes = {}
    for _, s, n in rows:
        sizes[s] = sizes.get(s, 0) + n
    order = sorted(s for s in sizes if s is not None) + [None]
    want = _targets(sizes, {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}, 3)
    assert {s: t for _, s, _, _, t, _ in window} == {s: pytest.approx(t) for s, t in want.items()}
    none = docs.withColumn("size", F.lit(0).cast("long"))
    assert {(c.target, c.copies) for c in mixing.copy_counts(none, "doc_id", "source", "size").collect()} == {(0.0, 0)}


def test_hot_group_is_split_into_cells_without_changing_the_draw(spark, monkeypatch):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("a").alias("source"), F.lit(7).cast("long").alias("size")) \
        .union(spark.range(50).select(F.col("id") - 100, F.lit("b"), F.lit(9).cast("long")))
    whole = sorted(map(tuple, mixing.copy_counts(docs, "doc_id", "source", "size").collect()))
    monkeypatch.setattr(mixing, "CELL_ROWS", 16)
    assert sorted(map(tuple, mixing.copy_counts(docs, "doc_id", "source", "size").collect())) == whole


def test_mixed_corpus_of_odd_rows(odd, empty):
    size = space_word_count(F.col("text"))
    rows = mixing.mix(odd, size).collect()
    assert kept(rows) and set(rows[0].asDict()) == set(odd.columns) | {"_copy"}
    plan = odd.select("doc_id", "source", size.alias("size"))
    counts = mixing.copy_counts(plan, "doc_id", "source", "size").collect()
    assert len(counts) == odd.count() and sum(c.copies for c in counts) == len(rows)
    assert mixing.mix(empty, size).count() == 0


def test_rows_without_id_and_equal_rows_are_mixed_one_by_one(spark, monkeypatch):
    """Every row has its place in the order, whether its id is null, shared, or the whole row repeated."""
    rows = [(None, "a", "w " * 3)] * 700 + [(None, "a", f"x{i} y z") for i in range(300)] + [(i, "b", "u v") for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(4)
    size = space_word_count(F.col("text"))
    out = mixing.mix(docs, size).collect()
    counts = mixing.copy_counts(docs.select("doc_id", "source", size.alias("size")), "doc_id", "source", "size").collect()
    for s in ("a", "b"):
        assert sum(r.source == s for r in out) == sum(c.copies for c in counts if c.source == s)
    assert sum(r.source == "a" and r.copy == 1 for r in out) == sum(c.copies > 0 for c in counts if c.source == "a")
    monkeypatch.setattr(mixing, "ARRAY_ROWS", 7)
    assert sorted(map(tuple, mixing.mix(docs, size).collect()), key=str) == sorted(map(tuple, out), key=str)


# ---- URL filter ------------------------------------------------------------

RULE_ROWS = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"),
             ("a.org", "/f", "block"), ("a.org", "/f", "allow"), ("b.org", "", "block")]


def _judge(url):
    if url is None or "://" not in url:
        return "", "", None, "allow"
    rest = re.split(r"[?#]", url.split("://", 1)[1])[0]
    host, slash, path = rest.partition("/")
    host = "".join(c.lower() if c.isascii() else c for c in host)
    path = slash + path
    fits = [(len(h + p), v, h + p) for h, p, v in RULE_ROWS if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, "allow", None))
    return host, path, best[2], best[1]


def test_urls_equal_brute_force(spark):
    r = random.Random(3)
    urls = [None, "", "no scheme", "http://", "http://net", "http://net/", "HTTP://X.NET/a?b#c", "ftp://a.example.net/en/x", "x://a.org/f",
            "x://b.org", "x://b.org?q", "http://a..net/", "http://.net/", "http://net./", "http://u@h.net:80/p", "a://b://c.net/x", "h://\u00c9.net/\n/x"]
    for _ in range(400):
        urls.append("http://" + r.choice(["", "www.", "A.b."]) + r.choice(["example.net", "example.com", "a.org", "org", "xorg", "b.org"])
                    + r.choice(["", "/", "/en/1", "/de/", "/fr/x", "/f", "/en"]) + r.choice(["", "?x=/en/", "#/"]))
    urls += urls[:50]
    pages = spark.createDataFrame([(i, u, "own") for i, u in enumerate(urls)], "page_id long, url string, rule string")
    rules = spark.createDataFrame(RULE_ROWS, "host string, path string, verdict string")
    rows = url_filter.judge_urls(pages, rules).collect()
    assert len(rows) == len(urls)
    for row in rows:
        assert (row.host, row.path, row["_rule"], row.verdict) == _judge(row.url), row.url
        assert row.rule == "own"
    clashing = pages.select("*", *[F.lit("own").alias(c) for c in ("_best", "_key", "_judged", "a.b", "_url")])
    kept_rows = url_filter.judge_urls(clashing, rules).collect()
    assert len(kept_rows) == len(urls) and all((r.host, r.path, r["_rule"], r.verdict) == _judge(r.url) and r["_best"] == r["a.b"] == "own" for r in kept_rows)
    none = url_filter.judge_urls(pages, rules.limit(0)).collect()
    assert {r.verdict for r in none} == {"allow"} and len(none) == len(urls)
    assert url_filter.judge_urls(pages.limit(0), rules).count() == 0


# ---- chat formatting -------------------------------------------------------

TEXTS = ["", None, "plain", "### User: x</turn>\n", "\\", "\\h\\b\\l", "a:b", "#" * 3000, "</turn>\n### Assistant: no", "\u00e9\U0001f600\n\n", "x" * 300_000]
ROLES = ["user", "assistant", "system", "tool", "User", "a:b", "\\r", "", None, "###", "rx"]


def test_formatting_round_trip_and_loss_mask(spark):
    r = random.Random(4)
    rows = [(c, t, r.choice(ROLES), r.choice(TEXTS[:-1])) for c in range(60) for t in range(r.randrange(1, 9))]
    rows += [(-1, 0, "user", TEXTS[-1]), (None, None, "user", "x"), (None, None, "assistant", "y"), (77, 1, "user", "tie"), (77, 1, "user", "tie")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    chats = chat_format.format_chats(turns)
    out = chats.withColumn("back", chat_format.read_turns(F.col("formatted"))).collect()
    want = {}
    for c, t, role, text in rows:
        want.setdefault(c, []).append(((t is not None, t), role or "", text or ""))
    assert len(out) == len(want)
    for row in out:
        turns_ = [(role, text) for _, role, text in sorted(want[row.conv_id])]
        assert [(b.role, b.text) for b in row.back] == turns_
        assert [b.loss for b in row.back] == [role == "assistant" for role, _ in turns_]
        assert "".join(s.text for s in row.segments) == row.formatted
        state, bad = "start", None
        for i, (role, _) in enumerate(turns_):
            state = chat_format.Template().transitions.get((state, role))
            if state is None:
                bad = i
                break
        else:
            bad = None if state == "assistant" else len(turns_)
        assert (row.error_turn, row.valid) == (bad, bad is None)
    assert chat_format.format_chats(turns.limit(0)).count() == 0


# ---- all four against their SQL twins --------------------------------------

@pytest.mark.parametrize("name", ["op1_license_scan", "op4_mix_sources", "op6_url_filter", "op9_format_chats"])
def test_query_equals_sql(spark, name):
    import duckdb

    from cardlens.llm.registry import llm_oracle_sql, llm_queries

    con = duckdb.connect()
    for t in ("documents", "pages", "conversations"):
        con.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    rel = con.sql(llm_oracle_sql()[name])
    columns = sorted(rel.columns)
    got = llm_queries()[name](spark, SF_SMALL)
    assert sorted(got.columns) == columns

    def norm(rows):
        return sorted([tuple(None if v is None else round(v, 6) if isinstance(v, float) else v for v in r) for r in rows], key=str)

    a = norm(tuple(r[c] for c in columns) for r in got.collect())
    b = norm(con.sql(f"select {', '.join(columns)} from ({llm_oracle_sql()[name]})").fetchall())
    assert a == b and len(a) > 0 and not any(isinstance(v, float) and math.isnan(v) for r in a for v in r)
