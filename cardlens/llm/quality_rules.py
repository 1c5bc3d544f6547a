"""Quality rules on tokeniser fertility.

Public vocabularies read every word of a text: a byte-level BPE gives characters
per token and the entropy of the token distribution, a BPE with byte fallback the
share of tokens that fall back to single bytes. Texts that the vocabularies cut
unlike the other texts of their language and length are rejected: the bands are
robust quantiles of the corpus itself, per language and length class.

Every class has a band, however few texts it has. Length is taken out first: a class's
centre is its median over all languages, drawn towards a curve fitted to the medians of the
*other* classes, so a text alone in its class is not judged against itself. The curve is a line in
2^(-class/2), as the measures settle with length; near classes weigh more, and as many are taken in
as ``PRIOR_TEXTS`` texts need. The quartiles of what is left are estimated for the
corpus, the script (of most letters of the text), the language and the language's
length class; each estimate is drawn towards the wider one as if that were worth
``PRIOR_TEXTS`` texts, so a class of many texts has its own band, one of few that of
its language, script or corpus at its length, and nothing flips at a count.

White space is not a token; a word is read with the vocabulary's word start.

The measures come from one pass over the text (Arrow batches); every different word is
encoded once and kept in a bounded cache.
The bands need the measures only: they are written to the shared folder, so
the text is read once.

Edge cases: null and empty texts have no words, null measures, and fail the base
rules; a null language counts as language of its own ("" in the bands); a text without
letters has script ""; repeated rows are measured and judged alike; an empty table
gives an empty result.
"""

from __future__ import annotations

import os
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ship_package, write_shared
from .columns import fresh, named
from .piece_cache import PieceCache, flatten
from .textarrays import spans

VOCABULARIES = os.environ.get("TOKENIZER_DIR", "/opt/tokenizers")
BPE_FILE = "byte_bpe_multi_50k.tiktoken"
PIECE_FILE = "piece_bpe_32k.model"
JOINED_WORDS = 1000
_OTHER_SPACE = re.compile(r"[^\S ]")
WINDOW_WORDS = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
PRIOR_TEXTS = 50
LENGTH_CLASSES = 64
BROADCAST_ROWS = 10_000
SYMBOLS = b"#*$%&|<>"
MEASURES = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, " \
           "n_tokens bigint, chars_per_token double, byte_share double, token_entropy double, script string"


class _Vocabularies(PieceCache):
    """The two vocabularies. A word's integers are its token ids, then its number of pieces and of byte pieces."""

    def __init__(self, folder: str):
        import base64

        import numpy as np
        import sentencepiece
        import tiktoken

        super().__init__()
        with open(os.path.join(folder, BPE_FILE), "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        pattern = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""
        self.bpe = tiktoken.Encoding("words", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.token_bytes = np.zeros(max(ranks.values()) + 1, np.int64)
        self.token_bytes[list(ranks.values())] = [len(k) for k in ranks]
        self.piece = sentencepiece.SentencePieceProcessor(model_file=os.path.join(folder, PIECE_FILE))
        self.is_byte = np.array([self.piece.is_byte(i) for i in range(self.piece.get_piece_size())])
        self.scripts, self.script_of = _script_table()

    def _tokens(self, words: list):
        """(token ids of all words, each with a space in front; ids per word; the words as text).

        The pattern cuts at every space, so the words are encoded as one text and told apart by the bytes of their tokens;
        words with other white space in them, or with bytes that are no text, go one by one.
        """
        import numpy as np

        raw = b" " + b" ".join(words)
        try:
            text = raw.decode()
        except UnicodeDecodeError:
            text = "\n"
        if _OTHER_SPACE.search(text):
            texts = [w.decode("utf-8", "replace") for w in words]
            return *flatten([self.bpe.encode_ordinary(" " + t) for t in texts]), texts
        ids = np.array(self.bpe.encode_ordinary(text), np.int64)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        stops = np.searchsorted(np.cumsum(self.token_bytes[ids]), ends) + 1
        return ids, np.diff(stops, prepend=0), text[1:].split(" ")

    def encode_new(self, words: list) -> tuple:
        import numpy as np

        parts = [self._tokens(words[i:i + JOINED_WORDS]) for i in range(0, len(words), JOINED_WORDS)]
        ids, tokens = (np.concatenate([p[k] for p in parts]) for k in (0, 1))
        flat, pieces = flatten(self.piece.encode([t for p in parts for t in p[2]], num_threads=1))
        total, ends = np.concatenate([[0], np.cumsum(self.is_byte[flat])]), np.cumsum(pieces)
        count = tokens + 2
        place = np.cumsum(count) - count
        out = np.empty(int(count.sum()), np.int64)
        out[spans(place, tokens)] = ids
        out[place + tokens], out[place + tokens + 1] = pieces, total[ends] - total[ends - pieces]
        return out, count


def _script_table():
    """Script names, and the script of a letter by its first two UTF-8 bytes (0: no letter), as Unicode names it."""
    import unicodedata

    import numpy as np

    names, found = {"": 0}, {}
    for point in [*range(0x80, 0xD800), *range(0xE000, 0x10000), *range(0x10000, 0x32000, 64)]:
        char = chr(point)
        if char.isalpha():
            name = unicodedata.name(char, "").split(" ")[0].split("-")[0]
            name = {"HIRAGANA": "KANA", "KATAKANA": "KANA", "HALFWIDTH": "KANA", "FULLWIDTH": "LATIN"}.get(name, name)
            lead = char.encode()[:2]
            counts = found.setdefault(lead[0] << 8 | lead[1], {})
            counts[name] = counts.get(name, 0) + 1
    names["LATIN"] = 1
    table = np.zeros(1 << 16, np.int64)
    for lead, counts in sorted(found.items()):
        table[lead] = names.setdefault(max(sorted(counts), key=counts.get), len(names))
    return np.array(list(names), object), table


def _scripts(part, at, vocabularies):
    """Name of the script that most letters of each text have ("" without letters)."""
    import numpy as np

    n, width = len(at) - 1, len(vocabularies.scripts)
    counts = np.zeros((n, width), np.int64)
    letter = np.zeros(256, bool)
    letter[65:91] = letter[97:123] = True
    total = np.concatenate([[0], np.cumsum(letter[part])])
    counts[:, 1] = total[at[1:]] - total[at[:-1]]
    leads = np.flatnonzero(part >= 0xC2)  # every one has a byte after it in its own text
    if len(leads):
        script = vocabularies.script_of[part[leads].astype(np.int64) << 8 | part[leads + 1]]
        owner = np.searchsorted(at, leads, side="right") - 1
        counts += np.bincount(owner * width + script, minlength=n * width).reshape(n, width)
    counts[:, 0] = 0
    return vocabularies.scripts[counts.argmax(axis=1)]


def _repeat_counts(hashes, first):
    """Words inside ``WINDOW_WORDS``-word windows found twice or more in their text, per text."""
    import numpy as np

    from .textarrays import mix64

    n, width = len(hashes), WINDOW_WORDS
    counts = np.diff(first)
    text_of = np.repeat(np.arange(len(counts)), counts)
    covered = np.zeros(n + 1, np.int64)
    if n >= width:
        with np.errstate(over="ignore"):
            window = np.zeros(n - width + 1, np.uint64)
            for k in range(width):
                window = window * np.uint64(0x9E3779B97F4A7C15) + hashes[k:n - width + 1 + k]
            window = mix64(window) + mix64(text_of[:len(window)].astype(np.uint64) + np.uint64(1))
        whole = text_of[:len(window)] == text_of[width - 1:]
        starts = np.flatnonzero(whole)
        order = starts[np.argsort(window[starts], kind="stable")]
        same = window[order][1:] == window[order][:-1]
        twice = np.zeros(n, bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        seen = np.cumsum(twice)
        before = np.concatenate([np.zeros(width, np.int64), seen[:-width]])
        covered[1:] = np.cumsum(seen > before)
    return covered[first[1:]] - covered[first[:-1]]


def _measure(data, bounds, vocabularies):
    """Columns of ``MEASURES`` for the given texts."""
    import numpy as np

    from .textarrays import mix64, words

    part = data[bounds[0]:bounds[-1]]
    at = bounds - bounds[0]

    def per_text(flags):
        total = np.concatenate([[0], np.cumsum(flags)])
        return total[at[1:]] - total[at[:-1]]

    starts, stops, first = words(data, bounds)
    n_words = np.diff(first)
    symbol = np.zeros(256, bool)
    symbol[list(SYMBOLS)] = True
    spaces = np.zeros(256, bool)
    spaces[[9, 10, 11, 12, 13, 32]] = True
    chars = per_text(((part & 0xC0) != 0x80) & ~spaces[part])
    dup_lines = np.zeros(len(n_words), np.int64)
    for i, (a, b) in enumerate(zip(bounds[:-1], bounds[1:])):
        lines = [x for x in data[a:b].tobytes().split(b"\n") if x.strip()]
        dup_lines[i] = len(lines) - len(set(lines))
    place, count = vocabularies.lookup(data, starts, stops - starts)
    codes, token_count = vocabularies.codes, count - 2
    pieces, fallback = codes[place + token_count].astype(np.int64), codes[place + token_count + 1].astype(np.int64)

    def sums(per_word):
        total = np.concatenate([[0], np.cumsum(per_word)])
        return total[first[1:]] - total[first[:-1]]

    n_tokens = sums(token_count)
    text_of = np.repeat(np.arange(len(n_words)), n_tokens)
    stream = codes[spans(place, token_count)].astype(np.int64)
    keys, times = np.unique((text_of << 20) | stream, return_counts=True)
    weight = np.bincount(keys >> 20, weights=times * np.log2(times), minlength=len(n_words)) if len(keys) else np.zeros(len(n_words))
    some = np.maximum(n_tokens, 1)
    entropy = np.log2(some) - weight / some
    n_pieces = np.maximum(sums(pieces), 1)
    return (n_words, chars, per_text(symbol[part]), dup_lines, _repeat_counts(mix64(place), first), n_tokens,
            chars / some, sums(fallback) / n_pieces, entropy, _scripts(part, at, vocabularies))


_loaded: dict = {}


def _measure_batches(text_at: int, keep_text: bool, folder: str):
    def run(batches):
        import numpy as np
        import pyarrow as pa

        from .textarrays import slices, text_bytes

        if folder not in _loaded:  # the Python worker keeps the vocabularies and their cache from task to task
            _loaded.clear()
            _loaded[folder] = _Vocabularies(folder)
        vocabularies = _loaded[folder]
        names = [f.split()[0] for f in MEASURES.split(", ")]
        for batch in batches:
            if not batch.num_rows:
                continue
            data, bounds = text_bytes(batch.column(text_at))
            found = [_measure(data, bounds[a:b + 1], vocabularies) for a, b in slices(bounds)]
            columns = [np.concatenate(c) for c in zip(*found)]
            empty = columns[0] == 0
            kinds = [pa.int64()] * 6 + [pa.float64()] * 3 + [pa.string()]
            arrays = [pa.array(c, kind, mask=empty if i >= 6 else None) for i, (c, kind) in enumerate(zip(columns, kinds))]
            rest = [(n, c) for i, (n, c) in enumerate(zip(batch.schema.names, batch.columns)) if keep_text or i != text_at]
            yield pa.RecordBatch.from_arrays([c for _, c in rest] + arrays, [n for n, _ in rest] + names)
    return run


def measure(docs: DataFrame, text_col: str = "text", keep_text: bool = False, folder: str = VOCABULARIES) -> DataFrame:
    """``docs`` with one struct column ``measures`` (fields of ``MEASURES``); the text only if asked for."""
    ship_package(docs.sparkSession)
    rest = [c for c in docs.columns if keep_text or c != text_col]
    inner = [f"c{i}" for i in range(len(rest))]  # neutral names on the way, so no column can clash with a measure
    columns = rest if keep_text else [*rest, text_col]
    sent = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(columns)])
    schema = ", ".join([*(f"c{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(rest)), MEASURES])
    out = sent.mapInArrow(_measure_batches(columns.index(text_col), keep_text, folder), schema)
    name = fresh(docs.columns, "measures")
    fields = F.struct(*[f.split()[0] for f in MEASURES.split(", ")])
    return out.select(*[F.col(i).alias(c) for i, c in zip(inner, rest)], fields.alias(name))


def base_failed(m: Column) -> Column:
    """Too few words, or too many of them inside repeated windows."""
    return (m["n_words"] < MIN_WORDS) | (100 * m["n_repeat_words"] > MAX_REPEAT_PERCENT * m["n_words"])


# measure: (narrowest quartile distance that counts, quartile distances below the lower quartile, above the upper one)
BANDS = {"chars_per_token": (0.04, 5.0, 5.0), "byte_share": (0.01, 10.0, 10.0), "token_entropy": (0.1, 2.0, 15.0)}


def _length_class(m: Column) -> Column:
    return F.floor(F.log2(F.greatest(m["n_words"], F.lit(1)))).cast("int")


def _quartiles(texts: DataFrame, level: str, *keys: str) -> DataFrame:
    """``level``: (number of texts, quartiles of each measure) per ``keys``."""
    ends = [F.percentile_approx(c, F.array(F.lit(0.25), F.lit(0.75)), F.lit(10_000)).alias(c) for c in BANDS]
    found = texts.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *ends)
    return found.select(*keys, F.struct("n", *BANDS).alias(level))


def _centres(texts: DataFrame) -> dict:
    """measure: its centre in each length class over all languages (at most ``LENGTH_CLASSES`` rows reach the driver)."""
    import numpy as np

    medians = [F.percentile_approx(c, 0.5, 10_000).alias(c) for c in BANDS]
    rows = texts.groupBy("length_class").agg(F.count(F.lit(1)).alias("n"), *medians).orderBy("length_class").collect()
    classes, out = np.arange(LENGTH_CLASSES), {}
    at, n = np.array([r["length_class"] for r in rows], int), np.array([float(r["n"]) for r in rows])
    x, x_at = 2.0 ** (-classes / 2), 2.0 ** (-at / 2)
    weights = np.stack([_neighbours(np.abs(at - c), np.where(at == c, 0.0, n)) for c in classes])
    total = weights.sum(1)
    some = np.maximum(total, 1e-300)
    middle = weights @ x_at / some
    spread = (weights * (x_at - middle[:, None]) ** 2).sum(1)
    own = np.zeros(LENGTH_CLASSES)
    own[at] = n
    for c in BANDS:
        median = np.array([r[c] for r in rows], float)
        level = weights @ median / some
        slope = (weights * (x_at - middle[:, None]) * (median - level[:, None])).sum(1) / np.where(spread > 0, spread, 1.0)
        curve = level + slope * np.minimum(total / PRIOR_TEXTS, 1.0) * (x - middle)
        mine = np.zeros(LENGTH_CLASSES)
        mine[at] = median
        out[c] = np.where(total > 0, (own * mine + PRIOR_TEXTS * curve) / (own + PRIOR_TEXTS), mine)
    return out


def _neighbours(distance, n):
    """Weights of other classes: fourfold less per class of distance, or as much less as leaves ``PRIOR_TEXTS`` texts in all."""
    import numpy as np

    weights = lambda rate: n * np.exp(-rate * distance)
    wanted, low, high = min(float(PRIOR_TEXTS), float(n.sum())), 0.0, float(np.log(4.0))
    if weights(high).sum() >= wanted:
        return weights(high)
    for _ in range(50):
        rate = (low + high) / 2
        low, high = (rate, high) if weights(rate).sum() >= wanted else (low, rate)
    return weights(low)


def fit_bands(measured: DataFrame, lang_col: str = "lang", measures: str = "measures") -> DataFrame:
    """(lang, length class, bands: script, low and high of each measure) of every language and length class among the
    measured texts that pass the base rules, and of every script in it. Texts with equal measures (exact copies) count
    once, so a large group of copies moves no quantile."""
    m = named(measures)
    texts = measured.filter((m["n_words"] > 0) & ~base_failed(m)) \
        .select(F.coalesce(named(lang_col), F.lit("")).alias("lang"), _length_class(m).alias("length_class"), m["n_tokens"].alias("n_tokens"),
                m["script"].alias("script"), *[m[c].alias(c) for c in BANDS]).distinct()
    texts = write_shared(texts, "band-texts")
    centres = {c: F.array(*map(F.lit, map(float, v)))[F.col("length_class")] for c, v in _centres(texts).items()}
    rest = texts.select("lang", "length_class", "script", *[(F.col(c) - centres[c]).alias(c) for c in BANDS])
    levels = ["__all", "__script", "__lang", "__class"]  # from the widest on
    rows = rest.select("lang", "length_class", "script").distinct() \
        .join(_quartiles(rest, "__class", "lang", "length_class"), ["lang", "length_class"]) \
        .join(_quartiles(rest, "__lang", "lang"), "lang") \
        .join(F.broadcast(_quartiles(rest, "__script", "script")), "script") \
        .crossJoin(F.broadcast(_quartiles(rest, "__all")))  # scripts are a few dozen, the corpus is one row
    edges = []
    for c, (narrowest, below, above) in BANDS.items():
        ends = []
        for i in (0, 1):
            end = F.col(levels[0])[c][i]
            for level in levels[1:]:
                n = F.col(level)["n"]
                end = (n * F.col(level)[c][i] + PRIOR_TEXTS * end) / (n + PRIOR_TEXTS)
            ends.append(centres[c] + end)
        width = F.greatest(ends[1] - ends[0], F.lit(narrowest))
        edges += [(ends[0] - below * width).alias(f"{c}_low"), (ends[1] + above * width).alias(f"{c}_high")]
    bands = rows.select("lang", "length_class", F.struct("script", *edges).alias("band"))
    return bands.groupBy("lang", "length_class").agg(F.array_sort(F.collect_list("band")).alias("bands"))


def judge(measured: DataFrame, lang_col: str = "lang", measures: str = "measures") -> DataFrame:
    """``measured`` with base_failed and kept (column names that clash get underscores in front)."""
    bands = write_shared(fit_bands(measured, lang_col, measures), "bands")
    lang, length, script, band = keys = [fresh(measured.columns, c) for c in ("_lang", "_length_class", "_script", "_band")]
    own = bands.select("lang", "length_class", F.explode("bands").alias("b")) \
        .select(F.col("lang").alias(lang), F.col("length_class").alias(length), F.col("b.script").alias(script), F.col("b").alias(band))
    m = named(measures)
    rows = measured.select("*", F.coalesce(named(lang_col), F.lit("")).alias(lang), _length_class(m).alias(length), m["script"].alias(script))
    own = F.broadcast(own) if own.count() <= BROADCAST_ROWS else own  # else Spark joins by shuffle
    rows = rows.join(own, keys[:3], "left")  # whatever passes the base rules has a band
    inside = F.lit(True)
    for c in BANDS:
        inside = inside & m[c].between(F.col(band)[f"{c}_low"], F.col(band)[f"{c}_high"])
    failed, kept = fresh(measured.columns, "base_failed"), fresh(measured.columns, "kept")
    return rows.select(*[named(c) for c in measured.columns], base_failed(m).alias(failed), (~base_failed(m) & inside).alias(kept))


def keep_good(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", folder: str = VOCABULARIES) -> DataFrame:
    """The rows of ``docs`` that pass, all columns kept. Texts and measures are written once to the shared folder."""
    measures = fresh(docs.columns, "measures")
    rows = judge(write_shared(measure(docs, text_col, True, folder), "measured"), lang_col, measures)
    return rows.filter(named(fresh([*docs.columns, measures], "kept"))).select(*[named(c) for c in docs.columns])
