"""Plain-Python versions of the operators' definitions."""

import math
import re
from collections import Counter

import xxhash

_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def space_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def fingerprint(text, width=3):
    words = space_words((text or "").translate(_LOWER))
    shingles = [" ".join(words[i:i + width]) for i in range(len(words) - width + 1)] or ([" ".join(words)] if words else [])
    ones = Counter(b for s in shingles for b in range(64) if xxhash.xxh64_intdigest(s.encode(), 42) >> b & 1)
    return sum(1 << b for b, n in ones.items() if 2 * n > len(shingles))


def groups(prints, distance=3):
    """{index: smallest index linked to it, itself included}"""
    parent = list(range(len(prints)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= distance:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


def quality_counts(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)"""
    words = space_words(text)
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    times, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if times[w] > 1:
            covered.update(range(i, i + 8))
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if space_words(line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"), dup, len(covered)


def shingles(text, width=5):
    words = re.findall("[0-9a-z\x80-\U0010ffff]+", (text or "").translate(_LOWER))
    return {tuple(words[i:i + width]) for i in range(len(words) - width + 1)}


def leaks(docs, items, containment=0.8):
    """{(doc, item): (shared, size)}; docs and items are (id, text) rows. An item of under five words is one shingle."""
    out = {}
    widths = [min(5, len(re.findall("[0-9a-z\x80-\U0010ffff]+", (t or "").translate(_LOWER)))) for _, t in items]
    wanted = [(i, w, shingles(t, w) if w else set()) for (i, t), w in zip(items, widths)]
    for d, text in docs:
        cut = {w: shingles(text, w) for w in set(widths) if w}
        for i, w, s in wanted:
            shared = len(cut[w] & s) if w else 0
            if s and shared >= containment * len(s) - 1e-9:
                out[d, i] = max(out.get((d, i), (0, 0)), (shared, len(s)))
    return out


class Bigrams:
    def __init__(self, texts):
        self.words, self.pairs, self.texts = Counter(), Counter(), 0
        for t in texts:
            tokens = self.tokens(t)
            self.words.update(tokens)
            self.pairs.update(zip(["<s>"] + tokens, tokens))
            self.texts += 1
        self.total, self.distinct = sum(self.words.values()), len(self.words)

    @staticmethod
    def tokens(text):
        return [("w", w) for w in space_words((text or "").translate(_LOWER))] + ["</s>"]

    def base(self, text):
        return sum(math.log10((self.words[w] + 1) / (self.total + self.distinct + 1)) for w in self.tokens(text))

    def known(self, text):
        return sum(self.words[w] > 0 for w in self.tokens(text))

    def score(self, text, weights):
        tokens, out = self.tokens(text), 0.0
        for v, w in zip(["<s>"] + tokens, tokens):
            c = self.texts if v == "<s>" else self.words[v]
            lam = weights[0 if not c else 1 + int(math.log2(c))]
            direct = self.pairs[v, w] / c if c else 0.0
            out += math.log10(lam[0] * direct + lam[1] * self.words[w] / max(self.total, 1) + lam[2] / (self.distinct + 1))
        return out


def rules_kept(rows, prior=50, classes=64):
    """Verdict of every row (lang, measures) by bands worked out with plain loops; ``measures`` as the operator takes them."""
    limits = {"chars_per_token": (0.04, 5.0, 5.0), "byte_share": (0.01, 10.0, 10.0), "token_entropy": (0.1, 2.0, 15.0)}
    failed = lambda m: m.n_words < 20 or 100 * m.n_repeat_words > 30 * m.n_words
    size = lambda m: int(math.log2(max(m.n_words, 1)))
    texts = {(lang or "", size(m), m.script, m.n_tokens, *(m[c] for c in limits)) for lang, m in rows if m.n_words and not failed(m)}
    at = lambda values, q: sorted(values)[math.ceil(q * len(values)) - 1]
    by_class = {}
    for t in texts:
        by_class.setdefault(t[1], []).append(t)
    verdicts, centre = [], {}
    for k, c in enumerate(limits):
        median = {g: at([t[4 + k] for t in ts], 0.5) for g, ts in by_class.items()}
        for g in range(classes):
            others = {o: float(len(ts)) for o, ts in by_class.items() if o != g}
            own = len(by_class.get(g, ()))
            if not others:
                centre[c, g] = median.get(g, 0.0)
                continue
            mass = lambda rate: sum(n * math.exp(-rate * abs(o - g)) for o, n in others.items())
            wanted, low, high = min(float(prior), sum(others.values())), 0.0, math.log(4.0)
            if mass(high) >= wanted:
                low = high
            else:
                for _ in range(50):
                    middle = (low + high) / 2
                    low, high = (middle, high) if mass(middle) >= wanted else (low, middle)
            w = {o: n * math.exp(-low * abs(o - g)) for o, n in others.items()}
            total, x = sum(w.values()), lambda o: 2.0 ** (-o / 2)
            mx, my = sum(w[o] * x(o) for o in w) / total, sum(w[o] * median[o] for o in w) / total
            sxx = sum(w[o] * (x(o) - mx) ** 2 for o in w)
            slope = sum(w[o] * (x(o) - mx) * (median[o] - my) for o in w) / sxx if sxx > 0 else 0.0
            curve = my + slope * min(total / prior, 1.0) * (x(g) - mx)
            centre[c, g] = (own * median[g] + prior * curve) / (own + prior) if own else curve
    rest = [(t[0], t[1], t[2], *(t[4 + k] - centre[c, t[1]] for k, c in enumerate(limits))) for t in texts]

    def band(c, k, lang, g, script):
        ends = []
        for q in (0.25, 0.75):
            end = at([t[3 + k] for t in rest], q)
            for own in ([t for t in rest if t[2] == script], [t for t in rest if t[0] == lang], [t for t in rest if t[:2] == (lang, g)]):
                end = (len(own) * at([t[3 + k] for t in own], q) + prior * end) / (len(own) + prior)
            ends.append(centre[c, g] + end)
        narrowest, below, above = limits[c]
        width = max(ends[1] - ends[0], narrowest)
        return ends[0] - below * width, ends[1] + above * width

    known = {}
    for lang, m in rows:
        if failed(m):
            verdicts.append(False)
            continue
        key = (lang or "", size(m), m.script)
        if key not in known:
            known[key] = [band(c, k, *key) for k, c in enumerate(limits)]
        verdicts.append(all(a <= m[c] <= b for (a, b), c in zip(known[key], limits)))
    return verdicts


def classifier_score(model, text, column_of):
    """Score of one text: every pair of inputs added up by itself; ``column_of`` gives a word's column."""
    import numpy as np

    text = text or ""
    raw, words = text.encode(), [w.encode() for w in space_words(text)]
    lower = [w.lower() for w in words]  # bytes: ASCII only
    n, letters = len(words), max(len(text), 1)
    counts = Counter(column_of(w) for w in lower)
    share = lambda chars: sum(raw.count(c) for c in chars) / letters
    each = lambda s: [bytes([c]) for c in s]
    structure = [math.log1p(n), math.log1p(len(text)), sum(map(len, words)) / max(n, 1), share(each(range(65, 91))), share(each(range(48, 58))),
                 share(each(b"#*$%&|<>")), share(each(b"!")), share(each(b".,;:?'\"()-")), sum(b >= 192 for b in raw) / letters,
                 math.log1p(raw.count(b"\n")) - math.log1p(n), len(counts) / max(n, 1), sum(a == b for a, b in zip(lower, lower[1:])) / max(n, 1),
                 max(counts.values(), default=0) / max(n, 1)]
    scaled = np.clip((np.array(structure) - model.mean) / model.spread, -4.0, 4.0) / math.sqrt(len(structure))
    norm = math.sqrt(sum(v * v for v in counts.values()))
    columns = [*counts, *range(len(model.linear) - len(structure), len(model.linear))]
    x = np.array([*(v / norm for v in counts.values()), *scaled])
    scaled_factors = model.factors[columns].astype(float) * x[:, None]
    pairs = scaled_factors @ scaled_factors.T
    z = model.bias + float(model.linear[columns].astype(float) @ x) + float(np.triu(pairs, 1).sum())
    return 1 / (1 + math.exp(-z))


class Densities:
    """Main text of a page built from nested tuples (tag, children or text) of div, section, span, b and a, worked out recursively."""

    def __init__(self, body):
        self.order, self.of = [], {}
        self.page = ("html", [body])
        self.body = body
        self._walk(self.page)
        linked = self.of[id(body)]["lc"] / max(self.of[id(body)]["c"], 1)
        for node in self.order:
            m = self.of[id(node)]
            c, t, lc, lt = m["c"], max(m["t"], 1), m["lc"], m["lt"]
            m["d"] = c / t * math.log(1 + c / max(lc, 1) * t / max(lt, 1)) / math.log(math.log(c / max(c - lc, 1) * lc + linked * c + math.e ** math.e)) if c else 0.0
        for node in self.order:
            kids = node[1] if node[0] != "#" else []
            self.of[id(node)]["s"] = sum(self.of[id(k)]["d"] for k in kids) if kids else self.of[id(node)]["d"]

    def _walk(self, node):
        self.order.append(node)
        m = self.of[id(node)] = {"c": 0, "t": 0 if node[0] == "#" else 1, "lc": 0, "lt": 0}
        if node[0] == "#":
            m["c"] = len("".join(node[1].split()))
            return
        for kid in node[1]:
            self._walk(kid)
            for k in m:
                m[k] += self.of[id(kid)][k]
        if node[0] == "a":
            m["lc"], m["lt"] = m["c"], m["t"]

    def _path(self, node, goal):
        if node is goal:
            return [node]
        for kid in node[1] if node[0] != "#" else ():
            rest = self._path(kid, goal)
            if rest:
                return [node, *rest]
        return []

    def text(self):
        inner = [n for n in self.order if n[0] != "#"]
        core = max(inner, key=lambda n: self.of[id(n)]["s"])
        if not self.of[id(core)]["s"]:
            return ""
        path = self._path(self.page, core)
        if core in (self.page, self.body):
            chosen = [core]
        else:
            threshold = min(self.of[id(n)]["d"] for n in path[1:])
            chosen = []

            def pick(node):
                if node is core or not any(node is p for p in path) and self.of[id(node)]["c"] and self.of[id(node)]["d"] >= threshold:
                    chosen.append(node)
                elif any(node is p for p in path):
                    for kid in node[1]:
                        pick(kid)

            for kid in self.body[1]:
                pick(kid)
        blocks = []
        for root in chosen:
            line = []

            def flush():
                joined = " ".join("".join(line).split())
                line.clear()
                if joined:
                    blocks.append(joined)

            def read(node):
                if node[0] == "#":
                    line.append(node[1])
                    return
                if node[0] in ("div", "section", "html", "body"):
                    flush()
                for kid in node[1]:
                    read(kid)
                if node[0] in ("div", "section", "html", "body"):
                    flush()

            read(root)
            flush()
        return "\n\n".join(blocks)
