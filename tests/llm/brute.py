"""Plain single-process versions of the operators, for comparison."""

from __future__ import annotations

import base64
import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import xxhash

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def bpe(text, encoding):
    ids = encoding.encode_ordinary(text or "")
    packed = b"".join(i.to_bytes(4, "little") for i in ids)
    return len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(encoding.decode_bytes(ids)).hexdigest()


def fingerprint(text) -> int:
    w = SPACED.findall((text or "").translate(LOWER))
    grams = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] if w else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(keys, fps):
    distinct = sorted(set(fps))
    root = {f: f for f in distinct}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            if (a ^ b).bit_count() <= 2:
                root[find(a)] = find(b)
    least = {}
    for k, f in zip(keys, fps, strict=True):
        r = find(f)
        least[r] = min(k, least.get(r, k))
    return [least[find(f)] for f in fps]


def warc(rows):
    largest = {}
    for page_id, html in rows:
        largest[html or ""] = max(page_id, largest.get(html or "", page_id))
    out = []
    for page_id, html in rows:
        payload, to = (html or "").encode(), largest[html or ""]
        revisit = to != page_id
        out.append((page_id, len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode(), "revisit" if revisit else "response", to if revisit else None))
    return out


def secrets(text):
    text = text or ""
    spans = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    spans += [(m.start(), 1, "access", m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    spans += [(m.start(), 2, "hex", m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 32]
    spans.sort()
    n = [sum(s[1] == k for s in spans) for k in range(3)]
    return *n, sha(",".join(f"{k}:{a}:{b}" for a, _, k, b in spans))


def secret_spans(text):
    """(start, end, kind) of the base rules, those that overlap an earlier one left out."""
    text, out, at = text or "", [], 0
    spans = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    spans += [(m.start(), 1, "access", m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    spans += [(m.start(), 2, "hex", m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 32]
    for start, _, kind, end in sorted(spans):
        if start >= at:
            out.append((start, end, kind))
            at = end
    return out


def contamination(text, items):
    words = WORD.findall((text or "").translate(LOWER))
    hit, found = [False] * len(words), set()
    for key, item in items:
        iw = WORD.findall((item or "").translate(LOWER))
        n = min(10, len(iw))
        wanted = {tuple(iw[i : i + n]) for i in range(len(iw) - n + 1)} if iw else set()
        for i in range(len(words) - n + 1 if wanted else 0):
            if tuple(words[i : i + n]) in wanted:
                found.add(str(key))
                hit[i : i + n] = [True] * n
    return len(words), sum(hit), len(found), sha(",".join(sorted(found))), any(hit)


def licenses(text):
    words = WORD.findall((text or "").translate(LOWER))
    places, labels = [], set()
    for phrase, label in PHRASES.items():
        p = phrase.split()
        own = [i for i in range(len(words) - len(p) + 1) if words[i : i + len(p)] == p]
        places += own
        labels |= {label} if own else set()
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def rules(text):
    text = text or ""
    w = SPACED.findall(text)
    windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    counts = {}
    for x in windows:
        counts[x] = counts.get(x, 0) + 1
    covered = {j for i, x in enumerate(windows) if counts[x] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if SPACED.search(x)]
    base = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), base


class KneserNey:
    """Interpolated modified Kneser-Ney of word trigrams, by the recursive formula."""

    def __init__(self, texts):
        self.counts = {k: {} for k in (1, 2, 3)}
        for t in texts:
            w = ["", "", *self.split(t)]
            for i in range(2, len(w)):
                g = tuple(w[i - 2 : i + 1])
                self.counts[3][g] = self.counts[3].get(g, 0) + 1
        for k in (2, 1):
            for g in self.counts[k + 1]:
                self.counts[k][g[1:]] = self.counts[k].get(g[1:], 0) + 1
        self.words = [w for (w,) in self.counts[1]]
        self.discount, self.total, self.kept = {}, {}, {}
        for k, table in self.counts.items():
            n = [sum(c == i for c in table.values()) for i in range(5)]
            y = n[1] / (n[1] + 2 * n[2]) if n[1] + n[2] else 0.5
            raw = [i - (i + 1) * y * n[i + 1] / n[i] if n[i] else 0.5 * i for i in (1, 2, 3)]
            self.discount[k] = [min(max(d, 0.1), 0.95 * i) for i, d in enumerate(raw, 1)]
            for g, c in table.items():
                self.total[k, g[:-1]] = self.total.get((k, g[:-1]), 0) + c
                self.kept[k, g[:-1]] = self.kept.get((k, g[:-1]), 0) + self.discount[k][min(c, 3) - 1]

    @staticmethod
    def split(text):
        return [w.decode() for w in (text or "").encode().lower().split()]

    def p(self, word, context):
        k = len(context) + 1
        lower = self.p(word, context[1:]) if context else 1 / (len(self.words) + 1)
        if (k, context) not in self.total:
            return lower
        total, c = self.total[k, context], self.counts[k].get((*context, word), 0)
        own = (c - self.discount[k][min(c, 3) - 1]) / total if c else 0
        return own + self.kept[k, context] / total * lower

    def perplexity(self, text):
        w = ["", "", *self.split(text)]
        if len(w) == 2:
            return None
        return math.exp(-sum(math.log(self.p(w[i], (w[i - 2], w[i - 1]))) for i in range(2, len(w))) / (len(w) - 2))


def telling_words(sets, toxic, least_rows, least_z, always):
    n, positives, found = len(toxic), sum(toxic), []
    for w in set().union(*sets):
        yes = sum(y for s, y in zip(sets, toxic, strict=True) if w in s)
        rows = sum(w in s for s in sets)
        a, b, c, d = yes + 0.5, positives - yes + 0.5, rows - yes + 0.5, n - positives - (rows - yes) + 0.5
        z = abs(math.log(a * d / (b * c)) / math.sqrt(1 / a + 1 / b + 1 / c + 1 / d))
        if rows >= least_rows and (z >= least_z or w in always):
            found.append(w)
    return sorted(found)


def logistic(rows, toxic, size, ridge):
    """Plain gradient descent."""
    x = np.zeros((len(rows), size))
    for i, own in enumerate(rows):
        x[i, own] = 1
    y, w, b = np.array(toxic, float), np.zeros(size), 0.0
    for _ in range(20_000):
        p = 1 / (1 + np.exp(-(x @ w + b)))
        w, b = w - 0.5 * (x.T @ (p - y) / len(y) + ridge * w), b - 0.5 * (p - y).mean()
    return lambda own: 1 / (1 + math.exp(-(w[own].sum() + b)))


def rebuilt(rows, family=5, most=9):
    """conv_id -> its rebuilt turns (role, text), from rows (conv_id, turn, role, text)."""
    own: dict = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    for turns in own.values():
        turns.sort(key=lambda t: (*t[:2], hashlib.sha256(f"{len(t[2].encode())}:{t[2]}{t[3]}".encode()).hexdigest()[:32]))
    out = {}
    for conv, turns in own.items():
        h = zlib.crc32(str(conv).encode()) % most
        out[conv] = [t[2:] for t in own.get(conv - conv % family, [])[:h] + turns[h:]]
    return out


def trie(conversations):
    """Nodes (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256) of conv_id -> turns."""
    members: dict = {}
    for conv, turns in conversations.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(conv)
    children: dict = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        below = children.get(node, [])
        leaves[node] = sum(leaves[c] for c in below) or 1
        saved[node] = sum(saved[c] for c in below) + ((len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0)
    out = []
    for node, convs in members.items():
        ends = ",".join(str(c) for c in sorted(convs) if len(conversations[c]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        out.append((min(convs), len(node), parent, len(convs), len(children.get(node, [])), leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return out


def license_labels(texts, templates, common):
    """labels and score of each text: every template against every file, word by word."""
    words = {i: WORD.findall((t or "").translate(LOWER)) for i, t in texts.items()}
    vocabulary = {w for _, t, _ in templates for w in t.split()} - common
    df = Counter(w for ws in words.values() for w in set(ws) & vocabulary)
    out = {}
    for i, ws in words.items():
        line = f" {' '.join(ws)} "
        labels = {label for phrase, label in PHRASES.items() if f" {phrase} " in line}
        score = 0.5 if labels else 0.0
        for label, template, key in templates:
            own = template.split()
            rare = sorted(set(own) & set(ws) - common, key=lambda w: (df[w], w))[:8]
            agree = Counter(o for w in rare for o in {p - at for p, x in enumerate(ws) if x == w for at, y in enumerate(own) if y == w})
            best = max(agree.values(), default=0)
            if best >= 2 and f" {key} " in line:
                labels.add(label)
                score = max(score, best / min(8, len(set(own) - common)))
        out[i] = (",".join(sorted(labels)), round(score, 9))
    return out
