"""Plain versions of the operators, for small inputs."""

import re
import zlib
from collections import Counter, defaultdict
from math import log10

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def simhash(text, width=3):
    words = WORD.findall(lower(text or ""))
    if not words:
        return 0
    grams = [" ".join(words[i:i + width]) for i in range(max(1, len(words) - width + 1))]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(fps, radius=3):
    """The smallest index of the component of each fingerprint."""
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(fps))]


def quality(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    count = Counter(windows)
    covered = {i + d for i, w in enumerate(windows) if count[w] > 1 for d in range(3)}
    lines, seen, dup = text.split("\n"), set(), 0
    for line in lines:
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered)


def bare(word):
    word = word.strip("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in word)


def stems(docs, toxic):
    """Stems by the rule of the quality operator, from ``(doc_id, text, lang)``; for tables no larger than its sample."""
    out, texts = set(), {}
    for text, lang, t in {(t, lang or "", toxic[i]) for i, t, lang in docs if i in toxic and t is not None}:
        texts.setdefault(lang, []).append((text, t))
    for own in texts.values():
        docs_of, hits = Counter(), (Counter(), Counter())
        for text, t in own:
            found = [{bare(w)[:k] for k in range(4, 10)} for w in WORD.findall(text) if bare(w)]
            if t:
                docs_of.update(set().union(*found))
            for s in found:
                hits[t].update(s)
        n_toxic = sum(t for _, t in own)
        out |= {s for s, n in docs_of.items() if n * log10(len(own) / n_toxic) >= 5 and 250 * n >= n_toxic and 20 * hits[1][s] >= 17 * (hits[0][s] + hits[1][s])}
    return out


def removed(docs, width=100):
    """Masks of removed bytes of ``docs`` in order."""
    seen, out = set(), []
    for raw in docs:
        mask = bytearray(len(raw))
        for i in range(len(raw) - width + 1):
            w = raw[i:i + width]
            if w in seen:
                mask[i:i + width] = b"\1" * width
            seen.add(w)
        out.append(mask)
    return out


def best_window(text, item, width=5):
    """The highest weighted Jaccard similarity of an item-sized window."""
    a, b = (re.findall(r"\w+", t.lower()) for t in (text or "", item))
    if not a or not b:
        return 0.0
    k = min(width, len(b))
    grams = lambda w: [tuple(w[i:i + k]) for i in range(len(w) - k + 1)]
    own, want = grams(a), grams(b)
    if not set(own) & set(want):
        return 0.0
    target, best = Counter(want), 0.0
    for i in range(max(1, len(own) - len(want) + 1)):
        window = Counter(own[i:i + len(want)])
        low = sum((window & target).values())
        high = sum((window | target).values())
        best = max(best, low / high)
    return best


def jump(key, shards):
    b, j = -1, 0
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) % (1 << 64)
        j = int((b + 1) * ((1 << 31) / ((key >> 33) + 1)))
    return b


def kneser_ney(rows, mod=7, held=2):
    """(held_out, n_tokens, n_known, N, base, score) of each (doc_id, text)."""
    out = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % mod == held
    tokens = lambda t: WORD.findall(lower(t or "")) + ["\n"]
    uni, pairs = Counter(), Counter()
    for i, t in rows:
        if not out(i):
            w = tokens(t)
            uni.update(w)
            pairs.update(zip(["\t"] + w, w))
    follow, before = defaultdict(Counter), Counter()
    for (v, w), n in pairs.items():
        follow[v][w] = n
        before[w] += 1

    def discounts(values):
        k = [sum(x == i for x in values) for i in range(1, 5)]
        y = k[0] / (k[0] + 2 * k[1]) if k[0] else 0.5
        d = [0.0] + [i - (i + 1) * y * k[i] / k[i - 1] if k[i - 1] else y for i in range(1, 4)]
        return [0.0] + [min(max(x, 0.05), i - 0.05) for i, x in enumerate(d) if i]
    d, e = discounts(list(pairs.values())), discounts(list(before.values()))
    types, vocabulary, total = len(pairs), len(uni), sum(uni.values())
    gamma0 = sum(e[min(n, 3)] for n in before.values()) / types if types else 1.0
    single = lambda w: (max(before[w] - e[min(before[w], 3)], 0) / types if types else 0) + gamma0 / (vocabulary + 1)

    def p(v, w):
        own = follow.get(v)
        if not own:
            return single(w)
        n, s = own[w], sum(own.values())
        return max(n - d[min(n, 3)], 0) / s + sum(d[min(x, 3)] for x in own.values()) / s * single(w)
    result = []
    for i, t in rows:
        w = tokens(t)
        result.append((out(i), len(w), sum(uni[x] > 0 for x in w), total, sum(log10((uni[x] + 1) / (total + vocabulary + 1)) for x in w),
                       sum(log10(p(a, b)) for a, b in zip(["\t"] + w, w))))
    return result, p, list(uni)


def kneser_ney_of_order(rows, order, mod=7, held=2):
    """Scores of each (doc_id, text) by a model of any order, the probability ``p(context, word)``, and the training tokens."""
    out = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % mod == held
    tokens = lambda t: ["\t"] * (order - 1) + WORD.findall(lower(t or "")) + ["\n"]
    grams = lambda w, k: [tuple(w[i - k + 1:i + 1]) for i in range(order - 1, len(w))]
    counts = {order: Counter(g for i, t in rows if not out(i) for g in grams(tokens(t), order))}
    for k in range(order - 1, 0, -1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    uni = Counter()
    for g, n in counts[order].items():
        uni[g[-1]] += n

    def discounts(values):
        k = [sum(x == i for x in values) for i in range(1, 5)]
        y = k[0] / (k[0] + 2 * k[1]) if k[0] else 0.5
        d = [i - (i + 1) * y * k[i] / k[i - 1] if k[i - 1] else y for i in range(1, 4)]
        return [0.0] + [min(max(x, 0.05), i - 0.05) for i, x in enumerate(d, 1)]
    d = {k: discounts(list(c.values())) for k, c in counts.items()}
    follow = {k: defaultdict(dict) for k in counts}
    for k, c in counts.items():
        for g, n in c.items():
            follow[k][g[:-1]][g[-1]] = n

    about = {(k, v): (sum(own.values()), sum(d[k][min(x, 3)] for x in own.values())) for k, by in follow.items() for v, own in by.items()}

    def p(context, w):
        k = len(context) + 1
        lower_p = p(context[1:], w) if k > 1 else 1 / (len(uni) + 1)
        if context not in follow[k]:
            return lower_p
        (s, kept), n = about[k, context], follow[k][context].get(w, 0)
        return max(n - d[k][min(n, 3)], 0) / s + kept / s * lower_p
    return [sum(log10(p(g[:-1], g[-1])) for g in grams(tokens(t), order)) for _, t in rows], p, list(uni)
