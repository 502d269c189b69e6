"""Plain Python versions of the operators' contracts, for small tables."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np

VISIBLE = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def lower(text):
    return (text or "").translate(LOWER)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def components(nodes, edges):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def decontaminate(docs, items, window=10):
    """{doc_id: (n_words, n_hit, n_items, items_sha256, contaminated)}"""
    owners = {}
    for item, text in items:
        words = ALNUM.findall(lower(text))
        if words:
            size = min(window, len(words))
            for i in range(len(words) - size + 1):
                owners.setdefault(tuple(words[i:i + size]), set()).add(str(item))
    sizes = sorted({len(w) for w in owners})
    out = {}
    for doc, text in docs:
        words = ALNUM.findall(lower(text))
        hit, found = set(), set()
        for size in sizes:
            for i in range(len(words) - size + 1):
                w = tuple(words[i:i + size])
                if w in owners:
                    hit.update(range(i, i + size))
                    found |= owners[w]
        out[doc] = (len(words), len(hit), len(found), sha(",".join(sorted(found))), bool(hit))
    return out


def near_items(docs, items, window=10, slack=2):
    """{doc_id: sorted ids of the items with a window whose words all occur within its length plus ``slack`` words}"""
    owners, times = {}, Counter()
    for item, text in items:
        words = ALNUM.findall(lower(text))
        size = min(window, len(words))
        for i in range(len(words) - size + 1 if words else 0):
            owners.setdefault((size, frozenset(words[i:i + size])), set()).add(str(item))
    split = {doc: ALNUM.findall(lower(text)) for doc, text in docs}
    for words in split.values():
        times.update(words)
    led = {}
    for size, terms in owners:
        led.setdefault(min(terms, key=lambda t: (times[t], t)), []).append((size, terms))
    out = {}
    for doc, words in split.items():
        found = set()
        for i, word in enumerate(words):
            for size, terms in led.get(word, ()):
                reach = size + slack
                if terms <= set(words[max(0, i - reach + 1):i + reach]) and any(terms <= set(words[s:s + reach]) for s in range(max(0, i - reach + 1), i + 1)):
                    found |= owners[size, terms]
        out[doc] = sorted(found)
    return out


def remove_repeats(docs, window=50):
    """{doc_id: (n_words, n_removed, kept_sha256)}"""
    first = {}
    split = {doc: VISIBLE.findall(text or "") for doc, text in docs}
    for doc, words in split.items():
        for i in range(len(words) - window + 1):
            w = tuple(words[i:i + window])
            first[w] = min(first.get(w, doc), doc)
    out = {}
    for doc, words in split.items():
        cut = set()
        for i in range(len(words) - window + 1):
            if first[tuple(words[i:i + window])] < doc:
                cut.update(range(i, i + window))
        out[doc] = (len(words), len(cut), sha(" ".join(w for i, w in enumerate(words) if i not in cut)))
    return out


def shingle_set(text, width):
    words = VISIBLE.findall(lower(text))
    if not words:
        return frozenset()
    width = min(width, len(words))
    return frozenset(tuple(words[i:i + width]) for i in range(len(words) - width + 1))


def near_duplicates(docs, width=2, percent=80):
    """{doc_id: (n_shingles, component_id)}; pairs are found through their shared shingles."""
    sets = {doc: shingle_set(text, width) for doc, text in docs}
    holders = {}
    for doc, s in sets.items():
        for x in s:
            holders.setdefault(x, []).append(doc)
    common = {}
    for found in holders.values():
        for i, a in enumerate(found):
            for b in found[i + 1:]:
                common[a, b] = common.get((a, b), 0) + 1
    edges = [(a, b) for (a, b), n in common.items() if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n)]
    of = components(list(sets), edges)
    return {doc: (len(sets[doc]), of[doc]) for doc in sets}


def vector_links(rows, threshold=0.95):
    """{vec_id: (n_links, component_id)}"""
    good = {k: np.array(v, float) for k, v in rows if v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    links, edges = dict.fromkeys((k for k, _ in rows), 0), []
    ids = list(good)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            x, y = good[a], good[b]
            if len(x) == len(y) and x @ y / (np.sqrt(x @ x) * np.sqrt(y @ y)) >= threshold:
                links[a] += 1
                links[b] += 1
                edges.append((a, b))
    of = components([k for k, _ in rows], edges)
    return {k: (links[k], of[k]) for k, _ in rows}


def held_out(key, parts):
    return zlib.crc32(str(key).encode()) % parts == 0


def base_scores(docs, folds=10):
    """{doc_id: (n_tokens, n_known, train_tokens, base_score)}"""
    tokens = {doc: [*VISIBLE.findall(lower(text)), "\n"] for doc, text in docs}
    counts = {}
    for doc, words in tokens.items():
        if not held_out(doc, folds):
            for w in words:
                counts[w] = counts.get(w, 0) + 1
    total, distinct = sum(counts.values()), len(counts)
    out = {}
    for doc, words in tokens.items():
        score = sum(np.log10((counts.get(w, 0) + 0.1) / (total + 0.1 * (distinct + 1))) for w in words)
        out[doc] = (len(words), sum(w in counts for w in words), total, score)
    return out


def ctw_scores(docs, depth=5, folds=10):
    """{doc_id: log10 probability} by the context tree as in its definition, node by node."""
    from math import lgamma, log, log10, exp, pi

    streams = {doc: list(lower(text).encode()) + [255] for doc, text in docs}
    counts = {}

    def steps(bytes_):
        past = [255] * depth
        for x in bytes_:
            node = 1
            for j in range(8):
                bit = x >> (7 - j) & 1
                yield tuple(past[::-1]), node, bit
                node = 2 * node + bit
            past = [*past[1:], x]

    for doc, stream in streams.items():
        if not held_out(doc, folds):
            for past, node, bit in steps(stream):
                for d in range(depth + 1):
                    counts.setdefault((past[:d], node), [0, 0])[bit] += 1

    def log_kt(n):
        return lgamma(n[0] + 0.5) + lgamma(n[1] + 0.5) - lgamma(sum(n) + 1) - log(pi)

    below, own, weighted = {}, {}, {}
    for d in range(depth, -1, -1):
        for (past, node), n in counts.items():
            if len(past) == d:
                own[past, node] = log_kt(n)
                c = below.get((past, node), 0.0)
                top = max(own[past, node], c)
                weighted[past, node] = own[past, node] if d == depth else top + log(exp(own[past, node] - top) + exp(c - top)) - log(2)
                if d:
                    up = (past[:-1], node)
                    below[up] = below.get(up, 0.0) + weighted[past, node]
    out = {}
    for doc, stream in streams.items():
        total = 0.0
        for past, node, bit in steps(stream):
            p = None
            for d in range(depth, -1, -1):
                n = counts.get((past[:d], node), [0, 0])
                kt = (n[bit] + 0.5) / (sum(n) + 1)
                if p is None:
                    p = kt
                else:
                    gap = below.get((past[:d], node), 0.0) - own.get((past[:d], node), 0.0)
                    share = 1 / (1 + exp(min(gap, 700)))
                    p = share * kt + (1 - share) * p
            total += log10(p)
        out[doc] = total
    return out


def prefix_trie(rows, most=4, block=20):
    """{(conv_id, depth): (parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256)} of (conv, turn, role, text) rows."""
    said = {}
    for conv, turn, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0)):
        said.setdefault(conv, []).append((role or "", text or ""))
    built = {}
    for conv, own in said.items():
        h = zlib.crc32(str(conv).encode()) % most
        built[conv] = tuple(said.get(conv - int(math.fmod(conv, block)), [])[:h] + own[h:])
    members = {}
    for conv, turns in built.items():
        for depth in range(len(turns) + 1):
            members.setdefault(turns[:depth], []).append(conv)
    children, below = {}, {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    for node in sorted(members, key=len, reverse=True):
        under = [below[c] for c in children.get(node, [])]
        own = (len(members[node]) - 1) * len(VISIBLE.findall(node[-1][1])) if node else 0
        below[node] = (sum(u[0] for u in under) or 1, own + sum(u[1] for u in under))
    out = {}
    for node, convs in members.items():
        ended = sorted(c for c in convs if len(built[c]) == len(node))
        out[min(convs), len(node)] = (
            min(members[node[:-1]]) if node else None, len(convs), len(children.get(node, [])), *below[node], sha(",".join(map(str, ended)))
        )
    return out


def divergence(docs, least=10, top=10):
    """{(lang, source, part, item): (value, rank)} of (text, lang, source) rows."""
    term = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
    counts, held = {}, {}
    for text, lang, source in docs:
        lang, own = lang or "", counts.setdefault((lang or "", source or ""), {})
        words = term.findall(lower(text))
        for w in words:
            own[w] = own.get(w, 0) + 1
        for w in set(words):
            held[lang, w] = held.get((lang, w), 0) + 1
    out = {}
    for lang in {k[0] for k in counts}:
        kept = [w for (at, w), n in held.items() if at == lang and n >= least]
        groups = {source: {w: c[w] for w in kept if w in c} for (at, source), c in counts.items() if at == lang}
        whole = {w: sum(g.get(w, 0) for g in groups.values()) for w in kept}

        def share(group):
            total = sum(group.values())
            return {w: 1 + 10**9 * (group.get(w, 0) + 2) // (total + 2 * len(kept)) for w in kept}

        def gap(p, q):
            return (p - q) * (p - q) // (p + q)

        q = share(whole)
        shares = {source: share(g) for source, g in groups.items()}
        for source, p in shares.items():
            pairs = [(-sum(gap(p[w], x[w]) for w in kept), other.encode(), other) for other, x in shares.items() if other != source]
            terms = [(-gap(p[w], q[w]), w.encode(), w) for w in groups[source] if p[w] > q[w]]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
                out |= {(lang, source, part, item): (-value, rank) for rank, (value, _, item) in enumerate(found, 1)}
    return out
