"""Plain versions of the operators over Python lists, for small tables."""

import hashlib
import math
import re
from collections import Counter, defaultdict
from html.parser import HTMLParser

LAST = 1 << 63


def words(text):
    return (text or "").encode().split()


def sha(parts):
    return hashlib.sha256(b" ".join(parts)).hexdigest()


def quality(text):
    own, text = words(text), text or ""
    triples = [tuple(own[i:i + 3]) for i in range(len(own) - 2)]
    counts = Counter(triples)
    covered = {i + j for i, t in enumerate(triples) if counts[t] > 1 for j in range(3)}
    lines, seen, doubled = text.split("\n"), set(), 0
    for line in lines:
        if words(line):
            doubled += line in seen
            seen.add(line)
    chars = sum(len(w.decode()) for w in own)
    failed = len(own) < 50 or 100 * len(covered) > 50 * len(own)
    return len(own), chars, sum(text.count(c) for c in "#*$%&|<>"), doubled, len(covered), failed


def kept_by_quality(rows, documents=20, percent=2, left=30):
    """rows: (doc_id, text, source). A boolean per row."""
    plain = lambda line: " ".join(re.sub(r"\d", "0", line.lower()).split())
    texts, held, hosts = defaultdict(set), defaultdict(set), defaultdict(set)
    cut = [(text, source, [(plain(x), len(words(x))) for x in (text or "").split("\n") if words(x)]) for _, text, source in rows]
    for text, source, lines in cut:
        for line, _ in lines:
            texts[source, line].add(text)
    for text, source, lines in cut:
        common = [(line, n) for line, n in lines if len(texts[source, line]) > documents]
        own = sum(n for _, n in lines) - sum(n for _, n in common)
        # which of the common lines stands for a near copy is a matter of hashes; any fixed order will do
        document = min(line for line, _ in common) if 9 * own < sum(n for _, n in lines) else ("text", text)
        if lines:
            hosts[source].add(document)
        for line, _ in common:
            held[source, line].add(document)
    out = []
    for text, source, lines in cut:
        n = len(words(text))
        gone = sum(k for line, k in lines if len(held[source, line]) > max(documents, percent * len(hosts[source]) / 100))
        out.append(not quality(text)[5] and 100 * (n - gone) >= left * n)
    return out


def shingles(text):
    own = words(text)
    return frozenset(tuple(own[i:i + 5]) for i in range(max(1, len(own) - 4))) if own else frozenset()


def linked(rows):
    """rows: (doc_id, text). Of each row its class (index of the row that stays) and its number of links."""
    sets, holders = [shingles(t) for _, t in rows], defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            holders[x].append(i)
    pairs, both = set(), Counter()
    for own in holders.values():
        both.update((a, b) for k, a in enumerate(own) for b in own[k + 1:])
    for (a, b), n in both.items():
        if 10 * n >= 8 * (len(sets[a]) + len(sets[b]) - n):
            pairs.add((a, b))
    root = list(range(len(rows)))
    changed = True
    while changed:
        changed = False
        for a, b in pairs:
            if root[a] != root[b]:
                root[a] = root[b] = min(root[a], root[b])
                changed = True
    least = {}
    for i, (doc, _) in enumerate(rows):
        key = (LAST if doc is None else doc, i)
        least[root[i]] = min(least.get(root[i], key), key)
    n = Counter(x for p in pairs for x in p)
    return [(least[root[i]][1], n[i]) for i in range(len(rows))]


def removed(rows, width=50):
    """rows: (doc_id, text). Of each row its kept words."""
    first, out = {}, {}
    for doc, text in rows:
        own = words(text)
        for i in range(len(own) - width + 1):
            key = tuple(own[i:i + width])
            first[key] = min(first.get(key, LAST), LAST if doc is None else doc)
    for at, (doc, text) in enumerate(rows):
        own = words(text)
        gone = set()
        for i in range(len(own) - width + 1):
            if first[tuple(own[i:i + width])] < (LAST if doc is None else doc):
                gone.update(range(i, i + width))
        out[at] = [w for i, w in enumerate(own) if i not in gone]
    return [out[i] for i in range(len(rows))]


def mix(rows, weights=(3, 1, 2)):
    """rows: (doc_id, text, source). (size, source size, target, whole, part) of each row."""
    sizes = [len(words(t)) for _, t, _ in rows]
    total = Counter()
    for n, (_, _, source) in zip(sizes, rows):
        total[source] += n
    order = sorted(total, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % 3] for i, s in enumerate(order)}
    capped = set()
    while True:
        rest, open_weight = 1.5 * sum(sizes) - sum(2 * total[s] for s in capped), sum(weight[s] for s in order if s not in capped)
        more = {s for s in order if s not in capped and 2 * total[s] <= weight[s] * rest / open_weight} if open_weight else set()
        if not more:
            break
        capped |= more
    target = {s: 2.0 * total[s] if s in capped else weight[s] * rest / open_weight for s in order}
    out = [None] * len(rows)
    for s in order:
        goal = math.floor(target[s] + 0.5)
        whole = goal // total[s] if total[s] else 0
        left = goal - whole * total[s]
        own = [i for i in range(len(rows)) if rows[i][2] == s]
        draw = lambda i: hashlib.md5(f"mix-1:{'null' if rows[i][0] is None else rows[i][0]}".encode()).hexdigest()
        for i in sorted(own, key=lambda i: (draw(i), -1 if rows[i][0] is None else rows[i][0], sizes[i])):
            part = min(sizes[i], left)
            left -= part
            out[i] = (sizes[i], total[s], target[s], whole, part)
    return out


def floored(vector, scale):
    import numpy as np

    return [math.floor(scale * float(np.float32(x))) for x in vector]


def codes(rows, parts, entries, rounds):
    """Codes and errors by vec_id, and the codebooks: plain rounds over all pairs of parts and entries."""
    part = len(rows[0][1]) // parts
    cut = {i: [v[p * part:(p + 1) * part] for p in range(parts)] for i, v in rows}
    books = [[list(cut[i][p]) for i in sorted(cut)[:entries]] for p in range(parts)]

    def nearest(value, book):
        return min((sum((a - b) ** 2 for a, b in zip(value, entry)), number) for number, entry in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            held = defaultdict(list)
            for v in cut.values():
                held[nearest(v[p], books[p])[1]].append(v[p])
            for number, own in held.items():
                books[p][number] = [sum(x) // len(own) for x in zip(*own)]
    found = {i: [nearest(v[p], books[p]) for p in range(parts)] for i, v in cut.items()}
    return {i: ("".join(f"{n:02x}" for _, n in f), sum(d for d, _ in f)) for i, f in found.items()}, books


def _logit(p):
    p = min(max(p, 1e-4), 1 - 1e-4)
    return math.log(p / (1 - p))


def _flat(x, y):
    """Weights of the ridge logistic regression: descent along each weight in turn, until nothing moves."""
    w, odds = [0.0] * len(x[0]), [0.0] * len(x)
    for _ in range(20_000):
        most = 0.0
        for j in range(len(w)):
            ridge = 1e-6 if j == len(w) - 1 else 1.0
            p = [1 / (1 + math.exp(-o)) for o in odds]
            slope = sum(r[j] * (t - q) for r, t, q in zip(x, y, p)) - ridge * w[j]
            step = slope / (sum(r[j] ** 2 for r in x) / 4 + ridge)  # the curve is nowhere steeper than this
            w[j] += step
            odds = [o + step * r[j] for o, r in zip(odds, x)]
            most = max(most, abs(step))
        if most < 1e-9:
            break
    return w


def chain_terms(rows, y, least, far):
    """rows: sets of terms. The terms that tell the classes apart, best first, one for each set of documents."""
    ones, out = sum(y), []
    zeros = len(y) - ones
    held = defaultdict(list)
    for i, own in enumerate(rows):
        for t in own:
            held[t].append(i)
    for t, docs in held.items():
        positive, share = sum(y[i] for i in docs), len(docs) / len(y)
        z = abs(positive / ones - (len(docs) - positive) / zeros) / math.sqrt(max(share * (1 - share), 1e-9) * (1 / ones + 1 / zeros))
        if len(docs) >= least and z >= far:
            out.append((-round(z, 9), t, tuple(docs)))
    seen = set()
    return [t for _, t, docs in sorted(out) if not (docs in seen or seen.add(docs))]


def chain(rows, categories, terms_of, folds, least, far):
    """rows: dicts of words, shape, fold and a label for each category. Out-of-fold and whole-fit probabilities by category."""
    many = [max(1, sum(r["words"].values())) for r in rows]
    counts = []
    for r in rows:
        own = Counter()
        for word, n in r["words"].items():
            for t in terms_of(word):
                own[t] += n
        counts.append(own)
    earlier, out = [[] for _ in rows], {}
    for c in categories:
        def fitted(chosen):
            y = [rows[i][c] for i in chosen]
            terms = chain_terms([set(counts[i]) for i in chosen], y, least, far)
            mean = [sum(rows[i]["shape"][k] for i in chosen) / len(chosen) for k in range(7)]
            std = [math.sqrt(sum((rows[i]["shape"][k] - mean[k]) ** 2 for i in chosen) / len(chosen)) + 1e-6 for k in range(7)]

            def line(i):
                links = [_logit(p) for p in earlier[i]] + ([_logit(math.prod(earlier[i]))] if len(earlier[i]) > 1 else [])
                own = counts[i]
                return ([float(t in own) for t in terms] + [math.log1p(1000 * own[t] / many[i]) / 4 for t in terms]
                        + [(v - m) / s for v, m, s in zip(rows[i]["shape"], mean, std)] + links + [1.0])

            w = _flat([line(i) for i in chosen], y)
            return lambda i: 1 / (1 + math.exp(-sum(a * b for a, b in zip(w, line(i)))))

        held = [0.5] * len(rows)
        for k in range(folds):
            model = fitted([i for i, r in enumerate(rows) if r["fold"] != k])
            for i, r in enumerate(rows):
                if r["fold"] == k:
                    held[i] = model(i)
        whole = fitted(list(range(len(rows))))
        out[c] = held, [whole(i) for i in range(len(rows))]
        earlier = [e + [p] for e, p in zip(earlier, held)]
    return out


class Paths(HTMLParser):
    """The lines of a page, each with the whole list of elements around it: (number, tag, attribute words, hidden)."""

    def __init__(self, names):
        super().__init__()
        self.names, self.path, self.lines, self.count = names, [], [], 0
        self.parts, self.tags = [], 0

    def cut(self):
        for aside in (False, True):
            own = [(data, linked) for data, linked, beside in self.parts if beside == aside]
            text = " ".join("".join(d for d, _ in own).split())
            if text:
                linked = sum(len(d.strip()) for d, is_linked in own if is_linked) >= 0.8 * len(text)
                self.lines.append({"text": text, "tags": self.tags, "linked": linked, "aside": aside, "path": list(self.path)})
        self.parts, self.tags = [], 0

    def marks(self, at):
        """Of the element at a place in the path."""
        _, tag, words, _ = self.path[at]
        title = tag == "form" or tag == "header" and not any(t in ("article", "main") for _, t, _, _ in self.path[:at])
        return set() if tag in ("html", "body") else words & self.names.MARKS | ({tag} if title else set())

    def state(self):
        unread = any(hidden or t in self.names.UNREAD for _, t, _, hidden in self.path if t not in ("html", "body"))
        aside = any(t in self.names.ASIDE or w & self.names.OTHERS for _, t, w, _ in self.path if t not in ("html", "body"))
        return unread, aside

    def handle_starttag(self, tag, attrs):
        names = self.names
        if tag not in names.INLINE:
            self.cut()
        if tag in ("article", "main"):
            while self.path and not any(t == "article" for _, t, _, _ in self.path) and (any(self.state()) or any(map(self.marks, range(len(self.path))))):
                self.path.pop()
        closes = names.CLOSES.get(tag, () if tag in names.INLINE else ("p",))
        for at in reversed(range(len(self.path))):
            if self.path[at][1] in closes:
                del self.path[at:]
                break
            if self.path[at][1] in names.STOPS:
                break
        self.tags += 1
        if tag not in names.VOID:
            values = [(k, (v or "").lower()) for k, v in attrs]
            words = set().union(*[names._words(v) for k, v in values if k in ("class", "id", "role")])
            hidden = any(k == "hidden" or (k, v) == ("aria-hidden", "true") or k == "style" and re.search(r"display\s*:\s*none", v) for k, v in values)
            self.path.append((self.count, tag, words, hidden))
            self.count += 1

    def handle_endtag(self, tag):
        if tag not in self.names.INLINE:
            self.cut()
        self.tags += 1
        for at in reversed(range(len(self.path))):
            if self.path[at][1] == tag:
                del self.path[at:]
                break
            if tag in self.names.INLINE and self.path[at][1] not in self.names.INLINE:
                break

    def handle_data(self, data):
        unread, aside = self.state()
        if not unread:
            self.parts.append((data, any(t == "a" for _, t, _, _ in self.path), aside))


def main_text(html, names):
    """names: the module with the lists of names and `clustered`. Every line is compared with every element around it."""
    page = Paths(names)
    page.feed(html or "")
    page.close()
    page.cut()
    lines = page.lines
    for x in lines:
        page.path = x["path"]
        x["marks"] = [(x["path"][i][0], m <= names.TITLES) for i in range(len(x["path"])) if (m := page.marks(i))]
        x["in"] = [(t, n) for n, t, _, _ in x["path"] if t in names.CONTAINERS]
        x["heading"] = any(t in names.HEADINGS for _, t, _, _ in x["path"])
        x["item"] = x["linked"] and any(t == "li" for _, t, _, _ in x["path"])

    def cluster(some):
        return [x for x, c in zip(some, names.clustered([names.Line(x["text"], x["tags"], *[None] * 7) for x in some])) if c] if some else []

    def size(some):
        return sum(len(x["text"]) for x in some)

    beside = [x for x in lines if x["aside"] and not x["linked"]]
    if sum(len(x["text"].split()) for x in beside) < 25 or any(not x["aside"] and not x["linked"] for x in cluster([x for x in lines if not x["item"]])):
        lines = [x for x in lines if not x["aside"]]
    plain = [x for x in lines if not x["item"]]
    telling = [x for x in cluster(plain) if not x["linked"]] if any(x["marks"] for x in plain) else []
    kept = []
    for x in lines:
        against = [t for n, t in x["marks"] if 2 * size([y for y in telling if n in [m for m, _ in y["marks"]]]) <= size(telling)]
        if not against or x["heading"] and all(against):
            kept.append(x)
    lines, voting = kept, [x for x in kept if not x["item"]] or kept
    if not voting:
        return ""
    content = cluster(voting)
    found = sorted({c for x in content for c in x["in"] if size([y for y in content if c in y["in"]]) >= 0.9 * size(content)}, key=lambda c: c[1])
    named = [c for c in found if c[0] == "article"] or [c for c in found if c[0] == "main"]
    if named:
        return " ".join(x["text"] for x in lines if named[0] in x["in"])
    chosen, own = (found or [None])[-1], [id(x) for x in content if not x["linked"]]
    if chosen:
        around = next(x["in"] for x in voting if chosen in x["in"])
        for c in reversed(around[:around.index(chosen)]):
            if c[0] in ("html", "body") or any(c in x["in"] and chosen not in x["in"] and id(x) not in own and not x["heading"] for x in lines):
                break
            chosen = c
    whole = chosen and chosen[0] not in ("html", "body")
    at = [i for i, x in enumerate(lines) if id(x) in own] or [0, len(lines)]
    return " ".join(x["text"] for i, x in enumerate(lines) if id(x) in own or (not chosen or chosen in x["in"]) and (
        not x["item"] or whole or at[0] <= i <= at[-1] or len(voting) == len(lines)))
