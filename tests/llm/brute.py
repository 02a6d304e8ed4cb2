"""Plain single-process versions of the operators, for small tables. Documents are (doc_id, text) pairs."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def shingles(text, n):
    words = WORD.findall(lower(text))
    if not words:
        return set()
    return {tuple(words)} if len(words) < n else {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}


def components(nodes, links):
    up = {x: x for x in nodes}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = sorted((top(a), top(b)))
        up[b] = a
    return {x: top(x) for x in nodes}


def ngram_groups(docs, n, num, den):
    """(doc_id, set size, component) per document."""
    sets = [shingles(t, n) for _, t in docs]
    links = []
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            shared = len(a & b)
            if shared and den * shared >= num * (len(a) + len(b) - shared):
                links.append((j, i))
    group = components(range(len(docs)), links)
    least = {}
    for i, g in group.items():
        if docs[i][0] is not None:
            least[g] = min(least.get(g, docs[i][0]), docs[i][0])
    return [(docs[i][0], len(sets[i]), least.get(group[i])) for i in range(len(docs))]


def without_repeats(docs, window):
    """(doc_id, words, removed words, sha256 of the rest) per document."""
    words = [WORD.findall(t or "") for _, t in docs]
    seen = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for (doc, _), w in zip(docs, words):
        gone = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone.update(range(i, i + window))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((doc, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def exact_groups(docs):
    """(doc_id, keep_id, group size, kept, sha256) per document; ids are distinct."""
    groups = {}
    for doc, text in docs:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", text or ""), []).append((doc, len(text or "")))
    out = []
    for bare, members in groups.items():
        keep = min(members, key=lambda m: (-m[1], m[0] is None, m[0]))[0]
        digest = hashlib.sha256(bare.encode()).hexdigest()
        out += [(doc, keep, len(members), doc == keep, digest) for doc, _ in members]
    return out


def phrase_places(text, phrases):
    """Number of words, and the start of every phrase."""
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))
    found = []
    for phrase, label in phrases.items():
        want = phrase.split()
        found += [(i, label) for i in range(len(words)) if words[i : i + len(want)] == want]
    return len(words), sorted(found)


def mixture(docs, quota, block):
    """doc_ids in the order of the mixture, slot by slot. docs: (doc_id, source)."""
    period = sum(quota.values())
    queues = {}
    for doc, source in sorted(docs, key=lambda d: (hashlib.md5(str("" if d[0] is None else d[0]).encode()).hexdigest(), d[0])):
        queues.setdefault(source or "", []).append(doc)
    blocks = {s: [q[i : i + block] for i in range(0, len(q), block)] for s, q in queues.items()}
    left, done, out, t = sum(map(len, blocks.values())), dict.fromkeys(quota, 0), [], 0
    while left:
        ready = [(-(-(done[s] + 1) * period // quota[s]), s) for s in quota if done[s] * period // quota[s] <= t]
        if ready:
            s = min(ready)[1]
            if done[s] < len(blocks[s]):
                out += blocks[s][done[s]]
                left -= 1
            done[s] += 1
        t += 1
    return out


def earliest_deadline_first(parts, blocks):
    """(source, block, slot) of every block, ties by source; every slot looks at all sources."""
    total, done, out, t = sum(parts), [0] * len(parts), [], 0
    while sum(done) < sum(blocks):
        ready = [i for i, n in enumerate(blocks) if done[i] < n and done[i] * total // parts[i] <= t]
        if ready:
            i = min(ready, key=lambda i: (-(-(done[i] + 1) * total // parts[i]), i))
            out.append((i, done[i], t))
            done[i] += 1
        t += 1
    return out
